"""Nested lists of the membership shop, in the order they are opened."""

from __future__ import annotations

# Column, prefix of its leaves, and which element stands for the list.
ORDER_LISTS = [
    ("payments", "payments_", "first"),
    ("statuses", "statuses_", "last"),
    ("shippings", "shippings_", "first"),
    ("shippings_products", "shippings_products_", "first"),
    ("shippings_products_custom", "shippings_products_custom_", "first"),
    ("benefit.promotions", "benefit_promotions_", "first"),
    ("shippings_products_stamps", "shippings_products_stamps_", "first"),
    ("shippings_products_allConfigurations", "shippings_products_all_configurations_", "first"),
]
USER_LISTS = [
    ("addresses", "addresses_", "first"),
    ("activeAddresses", "active_addresses_", "first"),
    ("person.phones", "person_phones_", "first"),
]
