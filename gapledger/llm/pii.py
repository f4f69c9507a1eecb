"""Personal data: base patterns, weak labelers, and a span classifier trained on their votes.

Base spans come from fixed patterns and always stay. Looser patterns propose further
spans. On all of them three labelers vote for, against or not at all: the strict
pattern, gazetteers, and words of the context before. Expectation-maximisation over
the counts of the vote patterns estimates how reliable each labeler is, kind by kind,
and so a probability for each pattern; a logistic classifier of a span's own features,
trained on these probabilities, decides about the proposed spans. Only the counts, a row
for each combination of kind, votes and features, reach the driver.

Patterns and positions are found by built-in functions alone: between the matches that
``regexp_extract_all`` gives lie the parts that ``split`` gives, and their lengths are
the positions.

Proposed emails have a name and a first label of 2 to 40 characters and further labels of
2 to 10; context is what stands in the 40 characters before a span, back to the match before.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.llm.staging import staged

KINDS = ("email", "ip", "card", "phone")

# Each finds the same as the plain pattern in its comment, but starts at one place of a run
# only, so long runs cost no more than their length; \G is where the match before ended.
# Repeated groups are possessive: Java runs through these in a loop, through others by
# recursion, which a name of some thousand labels would end.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+, those of 14 to 19 digits
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "email": r"(?i)\b[a-z0-9._-]{2,40} ?[\[(]at[\])] ?[a-z0-9-]{2,40}(?: ?(?:\.|[\[(]dot[\])]) ?[a-z]{2,10}+\b)++",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])",
}
#: What a text, for proposed spans in lower case, must contain for a pattern to be tried at all.
_NEEDS = {"email": "@", "phone": "+", "ip": "."}
_PROPOSED_NEEDS = {"email": ("(at)", "[at]")}

GAZETTEER = {
    # Top-level domains; network octets in use; leading digits of card issuers; calling codes.
    "email": r"(?i)[.\])] ?(?:com|org|net|edu|gov|info|io|de|fr|es|uk|it|eu)$",
    "ip": r"^(?!0|127\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[4578]|6)",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|contact|write|correo|courriel|kontakt)\W+(?:\w+\W+){0,3}$",
    "ip": r"(?i)\b(?:ip|address|host|server|adresse|login from)\W+(?:\w+\W+){0,3}$",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\W+(?:\w+\W+){0,3}$",
    "phone": r"(?i)\b(?:call|phone|tel|mobile|fax|telefon|t.l.phone|tel.fono)\W+(?:\w+\W+){0,3}$",
}
#: Words after which a number is no personal data.
AGAINST = r"(?i)\b(?:version|invoice|order|serial|isbn|issn|id|no|number)\W+$"
_CONTEXT_CHARACTERS = 40
_FEATURES = ("bracket", "separated", "long", "bounded")


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, match, before) of all matches, code points from 0, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(parts, 1, F.size(found)), lambda m, p: F.struct(
        m.alias("match"), F.length(p).alias("skip"), F.length(m).alias("size"),
        F.right(p, F.lit(_CONTEXT_CHARACTERS)).alias("before"),
    ))
    nothing = F.array().cast("array<struct<start:int,end:int,match:string,before:string>>")

    def place(done: Column, x: Column) -> Column:
        start = done["at"] + x["skip"]
        span = F.struct(
            start.alias("start"), (start + x["size"]).alias("end"), x["match"].alias("match"), x["before"].alias("before")
        )
        return F.struct((start + x["size"]).alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    return F.aggregate(pairs, start, place, lambda done: done["spans"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))
    places = F.sequence(F.lit(0), F.length(digits) - 1)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i + 1, F.lit(1)).cast("int") * (i % 2 + 1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        plain = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(match, r"\."), lambda p: (F.length(plain(p)) < 3) | (
            (F.length(plain(p)) == 3) & (plain(p) <= "255")
        ))
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _span(kind: str, x: Column, base: bool) -> Column:
    strict = F.lit(1 if base else 0)
    known = F.when(x["match"].rlike(GAZETTEER[kind]), F.lit(1)).otherwise(F.lit(-1))
    context = F.when(x["before"].rlike(CONTEXT[kind]), F.lit(1)).when(x["before"].rlike(AGAINST), F.lit(-1))
    return F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"),
        F.lit(base).alias("base"), F.array(strict, known, context.otherwise(F.lit(0))).alias("votes"),
        F.array(
            x["match"].rlike(r"[(\[]").cast("int"), x["match"].rlike("[ .-]").cast("int"),
            (F.length(x["match"]) > 14).cast("int"),
            (x["before"].rlike(r"\s$") | (F.length(x["before"]) == 0)).cast("int"),
        ).alias("features"),
    )


def candidate_spans(text: Column) -> Column:
    """Base and proposed spans of a text, each with votes and features; proposed ones touch no base span."""
    none = F.array().cast("array<struct<start:int,end:int,match:string,before:string>>")
    base = []
    for kind in KINDS:
        found = _matches(text, BASE[kind])
        if kind in _NEEDS:
            found = F.when(text.contains(_NEEDS[kind]), found).otherwise(none)
        good = F.filter(found, lambda x: _valid(kind, x["match"]))
        base.append(F.transform(good, lambda x: _span(kind, x, True)))
    proposed = []
    for kind, pattern in PROPOSED.items():
        found = _matches(text, pattern)
        if kind in _PROPOSED_NEEDS:
            needed = F.lit(False)
            for mark in _PROPOSED_NEEDS[kind]:
                needed = needed | F.lower(text).contains(mark)
            found = F.when(needed, found).otherwise(none)
        proposed.append(F.transform(found, lambda x: _span(kind, x, False)))
    return F.struct(F.concat(*base).alias("base"), F.concat(*proposed).alias("proposed"))


@dataclass
class VoteModel:
    """Of one kind: how often spans are real, and each labeler's votes on real and on other spans."""

    share: float
    real: list[dict[int, float]]
    other: list[dict[int, float]]

    def probability(self, votes: tuple[int, ...]) -> float:
        yes, no = self.share, 1 - self.share
        for v, real, other in zip(votes, self.real, self.other, strict=True):
            yes, no = yes * real[v], no * other[v]
        return yes / (yes + no)


def estimate_reliability(counts: dict[tuple[int, ...], int], rounds: int = 100) -> VoteModel:
    """Expectation-maximisation over the counts of vote patterns.

    It starts from labelers that are right more often than not, and adds a few votes of
    that kind, so that a labeler that never votes one way stays defined.
    """
    size = len(next(iter(counts)))
    start = {1: 0.6, 0: 0.3, -1: 0.1}
    model = VoteModel(0.5, [dict(start)] * size, [{v: start[-v] for v in start}] * size)
    for _ in range(rounds):
        weights = {votes: model.probability(votes) for votes in counts}
        whole = sum(counts.values())
        yes = sum(n * weights[v] for v, n in counts.items())
        real, other = [], []
        for i in range(size):
            said = {v: (sum(n * weights[p] for p, n in counts.items() if p[i] == v),
                        sum(n * (1 - weights[p]) for p, n in counts.items() if p[i] == v)) for v in start}
            real.append({v: (said[v][0] + 2 * start[v]) / (yes + 2) for v in start})
            other.append({v: (said[v][1] + 2 * start[-v]) / (whole - yes + 2) for v in start})
        model = VoteModel((yes + 1) / (whole + 2), real, other)
    return model


def train_classifier(rows: list[tuple[list[float], float, int]], rounds: int = 300, rate: float = 0.5) -> list[float]:
    """Logistic weights from (features, probability, count), by gradient descent with a small penalty."""
    if not rows:
        return []
    whole = sum(n for *_, n in rows)
    weights = [0.0] * len(rows[0][0])
    for _ in range(rounds):
        slope = [0.001 * w for w in weights]
        for x, p, n in rows:
            off = (1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, x, strict=True)))) - p) * n / whole
            slope = [s + off * v for s, v in zip(slope, x, strict=True)]
        weights = [w - rate * s for w, s in zip(weights, slope, strict=True)]
    return weights


def _classifier_inputs(rank: int, votes: tuple[int, ...], features: tuple[int, ...]) -> list[float]:
    kinds = [float(k == rank) for k in range(len(KINDS))]
    return [*kinds, float(votes[1]), float(votes[2]), *map(float, features)]


def _fit(candidates: DataFrame) -> list[float]:
    spans = candidates.select(F.explode(F.concat("c.base", "c.proposed")).alias("s"))
    table = spans.groupBy("s.rank", "s.votes", "s.features").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = []
    for rank in range(len(KINDS)):
        own = [(tuple(r["votes"]), tuple(r["features"]), r["n"]) for r in table if r["rank"] == rank]
        counts: dict[tuple[int, ...], int] = {}
        for votes, _, n in own:
            counts[votes] = counts.get(votes, 0) + n
        if counts:
            model = estimate_reliability(counts)
            rows += [(_classifier_inputs(rank, v, f), model.probability(v), n) for v, f, n in sorted(own)]
    return train_classifier(rows)


def _accepted(x: Column, weights: list[float], threshold: float) -> Column:
    if not weights:
        return F.lit(False)
    kinds, rest = weights[: len(KINDS)], weights[len(KINDS) :]
    inputs = [x["votes"][1], x["votes"][2], *[x["features"][i] for i in range(len(_FEATURES))]]
    score = F.element_at(F.array(*map(F.lit, kinds)), x["rank"] + 1)
    for w, v in zip(rest, inputs, strict=True):
        score = score + F.lit(w) * v
    return score >= F.lit(math.log(threshold / (1 - threshold)))


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["rank"], x["end"])))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(
        ":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string")
    )), ",")


def find_personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5
) -> DataFrame:
    """``<id>, base_spans, spans``: arrays of (start, rank, end, ...) of each row of ``docs``.

    ``rank`` is the place in ``KINDS``. A null text is empty; repeated rows are kept; other
    columns are not read. Without any candidate the arrays are empty.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    candidates = staged(docs.select(F.col(id_column).alias("id"), candidate_spans(text).alias("c")))
    weights = _fit(candidates)
    free = F.filter("c.proposed", lambda p: ~F.exists(
        "c.base", lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"])
    ))
    added = F.filter(free, lambda p: _accepted(p, weights, threshold))
    return candidates.select(
        F.col("id").alias(id_column), F.col("c.base").alias("base_spans"), F.concat("c.base", added).alias("spans")
    )


def span_digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``<id>, n_email, n_ip, n_card, n_phone, base_sha256, spans`` (counts of base spans)."""
    count = lambda rank: F.size(F.filter("base_spans", lambda x: x["rank"] == rank)).cast("long")
    return found.select(
        id_column, *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )
