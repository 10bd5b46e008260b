"""Reusable DataFrame operators; none of them knows about bookings."""
