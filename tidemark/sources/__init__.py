"""Feed contracts, text scans and raw landing."""
