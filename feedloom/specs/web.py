"""Paths and keys of the web analytics export."""

from __future__ import annotations

# Event parameters, each under its own name; text unless listed as whole number.
TEXT_PARAMS = [
    "transaction_id", "page_referrer", "page_location", "page_title", "btn_plano", "btn_text", "btn_section",
    "section", "source_platform", "has_credit_card", "has_address",
]
NUMBER_PARAMS = ["ga_session_id"]
PAYMENT_PARAMS = ["payment_type", "is_pix", "is_credit_card"]

# Flat names and the paths they are read from.
PATHS = {
    "category": "device.category",
    "mobile_brand_name": "device.mobile_brand_name",
    "mobile_marketing_name": "device.mobile_marketing_name",
    "operating_system": "device.operating_system",
    "operating_system_version": "device.operating_system_version",
    "browser": "device.web_info.browser",
    "city": "geo.city",
    "country": "geo.country",
    "sub_continent": "geo.sub_continent",
    "traffic_source_name": "traffic_source.name",
    "traffic_source_medium": "traffic_source.medium",
    "traffic_source_source": "traffic_source.source",
    "collected_campaign_id": "collected_traffic_source.manual_campaign_id",
    "collected_campaign": "collected_traffic_source.manual_campaign_name",
    "collected_source": "collected_traffic_source.manual_source",
    "collected_medium": "collected_traffic_source.manual_medium",
    "cross_channel_campaign_id": "session_traffic_source_last_click.cross_channel_campaign.campaign_id",
    "cross_channel_campaign": "session_traffic_source_last_click.cross_channel_campaign.campaign_name",
    "cross_channel_source": "session_traffic_source_last_click.cross_channel_campaign.source",
}
MEDIUM_PATH = "session_traffic_source_last_click.cross_channel_campaign.medium"
ITEM_FIELDS = {
    "item_name": "item_name",
    "periodicity": "item_category3",
    "operation": "item_category4",
    "coupon": "coupon",
}

# Events left out of the base table.
LEFT_OUT = [
    "pageView", "buttonClicked", "button_clicked-ancora_assine_a_peticao-p",
    "button_clicked-assinar_a_petição-page_ho", "button_clicked-fazer_download_do_selo-pa",
    "button_clicked-seja_sócio-torcedor-page_", "file_download",
]

# Event names the daily report counts.
PAGE_VIEW, ADD_TO_CART, PURCHASE = "page_view", "add_to_cart", "purchase"

TEXT_LENGTH = 250
