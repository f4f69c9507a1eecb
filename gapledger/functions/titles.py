"""Facts written into free-text request titles."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from gapledger.config import ApprovalRules


def clean_title(title: Column) -> Column:
    """Decode the two entities that occur, then drop square brackets."""
    for raw, shown in (("&ndash;", "-"), ("&amp;", "&"), ("[", ""), ("]", "")):
        title = F.replace(title, F.lit(raw), F.lit(shown))
    return title


# A site code: three capitals and a digit.
_CODE = (string.ascii_uppercase,) * 3 + (string.digits,)


def _without(stems: tuple[str, ...]) -> str:
    """Pattern that refuses a code with one of ``stems`` anywhere inside. A stem that fits no
    place of a code, say for its length or its characters, refuses none."""
    places = [
        "." * at + stem
        for stem in stems
        for at in range(len(_CODE) + 1 - len(stem))
        if all(c in _CODE[at + i] for i, c in enumerate(stem))
    ]
    return f"(?!{'|'.join(places)})" if places else ""


def site_codes(title: Column, excluded_stems: tuple[str, ...]) -> Column:
    """Distinct site codes in first-seen order, less those that contain an excluded stem."""
    codes = F.regexp_extract_all(title, F.lit(f"{_without(excluded_stems)}[A-Z]{{3}}[0-9]"), F.lit(0))
    return F.array_join(F.array_distinct(codes), ", ")


def keyword_tags(title: Column, keywords: tuple[str, ...], separator: str) -> Column:
    """Keywords contained in the title, in list order. Overlaps all count."""
    return F.concat_ws(separator, *[F.when(F.contains(title, F.lit(k)), k) for k in keywords])


def request_type(title: Column, lowered: Column) -> Column:
    """Start-up, real estate, both, or initiative; null when none is named.
    Construction counts as real estate. ``lowered`` is the title in lower case."""

    def mentions(word: str, code: str | None = None) -> Column:
        found = F.contains(lowered, F.lit(word))
        return found | F.contains(title, F.lit(f" {code} ")) if code else found

    startup, real_estate = mentions("startup", "SU"), mentions("real estate", "RE")
    return (
        F.when(startup, F.when(real_estate, "RE & SU").otherwise("SU"))
        .when(real_estate | mentions("construction", "CN"), "RE")
        .when(mentions("initiative"), "Initiative")
    )


def _lookup(key: Column, table: dict) -> Column:
    """Constant lookup, null when absent; folds into one map literal."""
    if not table:
        return F.lit(None)
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def region(title: Column, template_id: Column, rules: ApprovalRules) -> Column:
    """Region by template, else by the first two characters from the first
    letter on; folded into report regions, 'Check' when unknown."""

    def reported(raw: str) -> str:
        folded = rules.region_fold.get(raw, raw)
        return folded if folded in rules.region_rank else "Check"

    by_template = {template: reported(raw) for template, raw in rules.region_of_template.items()}
    by_prefix = {raw: reported(raw) for raw in (*rules.region_rank, *rules.region_fold)}
    # Letters as a case-blind A-Z match sees them, with the four non-ASCII
    # characters that fold to ASCII letters.
    prefix = F.regexp_extract(title, "(?s)[A-Za-z\u0130\u0131\u017F\u212A].?", 0)
    return F.coalesce(_lookup(template_id, by_template), _lookup(prefix, by_prefix), F.lit("Check"))


def region_rank(region_name: Column, rules: ApprovalRules, fallback: int) -> Column:
    return F.coalesce(_lookup(region_name, rules.region_rank), F.lit(fallback))
