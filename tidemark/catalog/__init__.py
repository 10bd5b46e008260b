"""Every operator over the star-schema test tables, with the same question in SQL."""
