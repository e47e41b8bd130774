"""The policy for catalog dumps that comes with the package.

Closed lists of formats, identifier types and company roles are those of the vocabularies, so a rule
and the block it watches cannot drift apart.
"""

from __future__ import annotations

from typing import Any

from dumpmill.operators.blocks import vocabulary
from dumpmill.plans.policy import Policy, parse_policy

# The genres of the catalog.
GENRES = (
    "Blues", "Brass & Military", "Children's", "Classical", "Electronic", "Folk, World, & Country", "Funk / Soul", "Hip Hop", "Jazz", "Latin", "Non-Music", "Pop",
    "Reggae", "Rock", "Stage & Screen")


def shipped_source(first_year: int = 1860, last_year: int = 2027) -> dict[str, Any]:
    """The policy as it would be loaded from YAML. Years outside the two are taken for unknown."""
    junk = [{"field": "profile", "contains": "DO NOT USE", "reason": "Entry marked DO NOT USE"}]
    numbers = {"field": "genres.genre", "remove_matching": r"^\d+$", "reason": "Numeric genre"}
    years = {"type": "range", "below": first_year, "above": last_year}
    when = lambda field: {"field": field, "nullify_when": years, "reason": "Implausible year"}
    need = lambda name, field: {"name": name, "field": field, "severity": "error", "condition": {"type": "required"}}
    known = lambda name, field, values: {"name": name, "field": field, "severity": "warning", "condition": {"type": "enum", "values": list(values)}}
    return {
        "skip_records": {"artists": junk, "labels": junk},
        "filters": {"releases": [numbers, when("released"), when("year")], "masters": [numbers, when("year")]},
        "rules": {
            "releases": [
                need("missing-title", "title"), known("genre-not-recognized", "genres.genre", GENRES),
                known("format-not-recognized", "formats.format.@name", vocabulary("media_taxonomy")["formats"]),
                known("identifier-type-not-recognized", "identifiers.identifier.@type", vocabulary("identifier_types")["raw"]),
                known("company-role-not-recognized", "companies.company.entity_type_name", vocabulary("company_roles")["raw"])],
            "artists": [need("empty-artist-name", "name")],
            "labels": [need("empty-label-name", "name")]},
    }


def shipped_policy(first_year: int = 1860, last_year: int = 2027) -> Policy:
    return parse_policy(shipped_source(first_year, last_year))
