"""Job: one verdict per message."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from claimspark.operators import header as h


def resolved_headers(messages: DataFrame, insurers: DataFrame, companies: DataFrame, providers: DataFrame,
                     terminations: DataFrame, cfg: DataFrame, as_of: date, tenant: int) -> DataFrame:
    """Messages with operator, provider and every verdict but the login's."""
    read = h.check_version(h.message_fields(messages, as_of))
    planned = h.check_tenant(h.resolve_plan(read, insurers, companies))
    provided = h.provider_verdict(h.resolve_provider(planned, providers, tenant))
    return h.needs_credentials(h.termination_verdict(provided, terminations, as_of), cfg, tenant)


def validate_headers(messages: DataFrame, insurers: DataFrame, companies: DataFrame, providers: DataFrame,
                     terminations: DataFrame, addresses: DataFrame, links: DataFrame, authorisers: DataFrame, cfg: DataFrame,
                     as_of: date, tenant: int = 1, fix_network_login: bool = False) -> DataFrame:
    resolved = resolved_headers(messages, insurers, companies, providers, terminations, cfg, as_of, tenant)
    matched = h.match_credentials(resolved, providers, addresses, links, authorisers, cfg, tenant)
    return h.header_verdict(h.network_login(matched, cfg, fix_network_login))
