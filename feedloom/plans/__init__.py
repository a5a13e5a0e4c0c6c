"""Composed pipelines."""

from feedloom.plans.catalogue import catalogue_rows, clean_events
from feedloom.plans.clients import clean_clients, load_clients
from feedloom.plans.crm import CrmColumns, crm_daily, crm_daily_fused, crm_parts, crm_shape, load_crm_day, read_crm
from feedloom.plans.dims import replicate
from feedloom.plans.ecommerce import ecommerce_customers, ecommerce_orders, read_exports
from feedloom.plans.entries import entry_tickets, load_entries
from feedloom.plans.facts import (
    build_fact,
    build_integration,
    extend_dim,
    extend_dim_entries,
)
from feedloom.plans.loads import (
    events_of_dates,
    load_all,
    load_client_table,
    load_dim,
    load_dim_entries,
    load_ecommerce,
    load_fact,
    load_integration,
    load_web_day,
    load_window,
    stage_window,
)
from feedloom.plans.shop import shop_orders, shop_users
from feedloom.plans.tickets import clean_tickets, refresh_tickets, ticket_counters
from feedloom.plans.web_events import event_base

__all__ = [
    "CrmColumns", "build_fact", "build_integration", "catalogue_rows", "clean_clients", "clean_events",
    "clean_tickets", "crm_daily", "crm_daily_fused", "crm_parts", "crm_shape", "ecommerce_customers",
    "ecommerce_orders", "entry_tickets", "event_base", "events_of_dates", "extend_dim", "extend_dim_entries", "load_all", "load_client_table", "load_clients", "load_crm_day",
    "load_dim", "load_dim_entries", "load_ecommerce", "load_entries", "load_fact", "load_integration", "load_web_day", "load_window", "stage_window", "read_crm", "read_exports", "refresh_tickets", "replicate", "shop_orders", "shop_users",
    "ticket_counters",
]
