"""Region of a box, by the rule of its platform."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tvtrail.schemas import DEFAULT_REGION

# --- fixed values: telecom id prefixes, in rule order; the first hit wins ---
# (region, prefixes of a user id)
TELECOM_PREFIXES = (
    ("14302", ("ZZ", "LL", "YX", "CL", "732", "07312")),
    ("14303", ("XT", "733", "07315")),
    ("14307", ("CD", "736", "0736")),
    ("14306", ("YY", "730", "0730")),
    ("14309", ("IY", "737", "0737")),
    ("14313", ("LD", "738", "0738")),
    ("14331", ("JS", "743", "0743")),
    ("14308", ("ZJ", "744", "0744")),
    ("14312", ("HH", "745", "0745")),
    ("14305", ("wg", "sn", "SY", "739", "0739")),
    ("14310", ("CZ", "AR", "GD", "GY", "JQ", "JH", "LW", "RC", "YX", "735", "0735")),
    ("14311", ("YZ", "DA", "DX", "JH", "LS", "NY", "QY", "SP", "YZ", "ZS", "746", "0746")),
    ("14304", ("HY", "HN", "LY", "HS", "HD", "QD", "CN", "734", "0734")),
)

# --- fixed values: unicom area code -> region -------------------------------
UNICOM_AREAS = {
    "0001": "14301", "0002": "14302", "0003": "14303", "0004": "14304",
    "0005": "14306", "0006": "14307", "0007": "14311", "0008": "14305",
    "0009": "14331", "0010": "14312", "0011": "14309", "0012": "14308",
    "0013": "14310", "0014": "14313",
}

# --- fixed values: unicom phone prefix -> area code --------------------------
UNICOM_PHONES = {
    "073108": "0001", "073102": "0002", "073105": "0003", "0734": "0004",
    "0730": "0005", "0736": "0006", "0746": "0007", "0739": "0008",
    "0743": "0009", "0745": "0010", "0737": "0011", "0744": "0012",
    "0735": "0013", "0738": "0014",
}

# --- fixed values: mobile area code -> region --------------------------------
MOBILE_AREAS = {
    "07300": "14306", "07311": "14303", "07312": "14302", "07340": "14304",
    "07350": "14310", "07360": "14307", "07370": "14309", "07380": "14313",
    "07390": "14305", "07440": "14308", "07450": "14312", "07460": "14311",
    "07430": "14331",
}


def _literal_map(table: dict[str, object]) -> Column:
    pairs = ", ".join(f"'{key}', '{value}'" for key, value in table.items())
    return F.expr(f"map({pairs})")


def _lookup(code: Column, table: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(table), code), F.lit(DEFAULT_REGION))


def telecom_region(user: Column) -> Column:
    """Region of the first rule one of the id's prefixes belongs to.

    Per prefix length a constant map gives the rule's rank; the least rank wins.
    """
    rank: dict[int, dict[str, str]] = {}
    for place, (_, prefixes) in enumerate(TELECOM_PREFIXES):
        for prefix in prefixes:
            rank.setdefault(len(prefix), {}).setdefault(prefix, f"{place:02d}")
    hits = [
        F.try_element_at(_literal_map(ranks), F.substring(user, 1, length))
        for length, ranks in rank.items()
    ]
    regions = {f"{place:02d}": region for place, (region, _) in enumerate(TELECOM_PREFIXES)}
    return _lookup(F.least(*hits), regions)


def unicom_region(user: Column, known_area: Column) -> Column:
    """``known_area`` is the dictionary's area code of the user, null if absent."""
    rule = F
    for prefix, area in UNICOM_PHONES.items():
        rule = rule.when(F.startswith(user, F.lit(prefix)), F.lit(area))
    area = F.coalesce(F.nullif(known_area, F.lit("")), rule.otherwise(F.lit("")))
    return _lookup(F.trim(area), UNICOM_AREAS)


def mobile_region(area: Column) -> Column:
    """Area codes map to regions; a region id given as area code maps to itself."""
    return _lookup(area, MOBILE_AREAS | {region: region for region in MOBILE_AREAS.values()})
