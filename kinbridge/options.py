"""Switches between the strict rules and the historic (compat) ones.

Every field names one place where the historic behaviour is ambiguous or loses
data.  ``STRICT`` is the default everywhere; ``COMPAT`` reproduces the historic
tables for users who need to compare them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Semantics:
    #: Trim strings and treat blank ones as missing before any rule runs.
    blank_is_missing: bool = True
    #: Accept only ISO-8601 instants with a zone; otherwise Spark's lenient parse,
    #: which turns a bare time of day into *today*.
    iso_timestamps_only: bool = True
    #: Reject events whose time is present but unparseable.
    event_time_must_parse: bool = True
    #: Give an unparseable input line its own reason instead of "missing id".
    label_corrupt_lines: bool = True
    #: Reject tenants containing the separator used inside the canonical id.
    forbid_separator_in_tenant: bool = True
    #: Reject customers lacking id, tenant or email instead of hashing what is left.
    validate_customers: bool = True
    #: Match accounts on (tenant, email); otherwise on email alone.
    tenant_scoped_match: bool = True
    #: Ignore events without a tenant when learning an app account's tenants.
    known_tenants_only: bool = True
    #: Learn tenants from accepted events only (off: from all raw events).
    tenants_from_accepted_only: bool = False
    #: Give app accounts without events the tenant of their PAM twin, when unique.
    tenant_from_pam_twin: bool = True
    #: Leave sessions of a PAM id seen in several tenants unresolved.
    one_tenant_per_pam_id: bool = True
    #: Keep facts without a canonical id out of the fact tables.
    facts_need_identity: bool = True
    #: Replace activity facts by natural key; otherwise by the wide sort key.
    replace_by_natural_key: bool = True
    #: ``first_seen_at`` is the earlier of both systems (off: PAM wins).
    earliest_first_seen: bool = False


STRICT = Semantics()

COMPAT = Semantics(
    blank_is_missing=False,
    iso_timestamps_only=False,
    event_time_must_parse=False,
    label_corrupt_lines=False,
    forbid_separator_in_tenant=False,
    validate_customers=False,
    tenant_scoped_match=False,
    known_tenants_only=False,
    tenant_from_pam_twin=False,
    one_tenant_per_pam_id=False,
    facts_need_identity=False,
    replace_by_natural_key=False,
)
