"""The whole warehouse as one lazy plan."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from kinbridge.options import STRICT, Semantics
from kinbridge.plans import facts, identity, validation
from kinbridge.sources.bundle import Sources


def labelled_customers(
    sources: Sources, tenants: DataFrame, sem: Semantics = STRICT
) -> tuple[DataFrame, DataFrame]:
    pam = validation.label_pam_customers(sources.pam_customers, sem)
    enriched = identity.with_tenants(
        sources.app_customers, tenants, validation.accepted(pam), sem
    )
    return pam, validation.label_app_customers(enriched, sem)


class Star:
    """Every table of the warehouse as a plan, made when first asked for.

    Facts may still lack a customer (see ``facts.resolved``).
    """

    def __init__(self, sources: Sources, sem: Semantics = STRICT):
        self.sources = sources
        self.sem = sem

    @cached_property
    def events(self) -> DataFrame:
        """Raw events with types and rejection reason."""
        return validation.label_events(self.sources.activity_events, self.sem)

    @cached_property
    def sessions(self) -> DataFrame:
        """Raw sessions with types and rejection reason."""
        return validation.label_sessions(self.sources.customer_sessions, self.sem)

    @cached_property
    def _customers(self) -> tuple[DataFrame, DataFrame]:
        tenants = identity.observed_tenants(self.sources.activity_events, self.sem)
        return labelled_customers(self.sources, tenants, self.sem)

    @property
    def pam(self) -> DataFrame:
        return self._customers[0]

    @property
    def app(self) -> DataFrame:
        return self._customers[1]

    @cached_property
    def claims(self) -> DataFrame:
        """Accepted accounts of both systems."""
        return identity.claims(self.pam, self.app)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return identity.customer_dimension(self.claims, self.sem)

    @cached_property
    def bridge(self) -> DataFrame:
        return identity.identity_bridge(self.claims)

    @cached_property
    def activity(self) -> DataFrame:
        unique = validation.unique_events(validation.accepted_events(self.events))
        return facts.activity_facts(unique, self.bridge)

    @cached_property
    def session(self) -> DataFrame:
        unique = validation.unique_sessions(validation.accepted(self.sessions))
        return facts.session_facts(unique, self.bridge, self.sem)


def plan_star(sources: Sources, sem: Semantics = STRICT) -> Star:
    return Star(sources, sem)
