"""Personal data by aggregating weak labels, with DataFrame functions only.

Patterns propose spans. Three labelers vote on each span (yes, no, or nothing): its format, gazetteers of what such values
start or end with, and the words around it. Expectation-maximisation over all spans of the corpus estimates how reliable
each labeler is and how common true spans of each kind are. Its posteriors are the soft labels of a logistic span
classifier over votes, kind, length and neighbours, which then decides about every span.

Scale: votes and features are small integers, so the corpus is summed up as counts per vector before anything is fitted;
their number is bounded by the product of the value ranges, whatever the size of the corpus. Only that table reaches the
driver. Finding and deciding happen within a document's row, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import spare, text_of
from rolemart.llm.native import let, running

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "spoken_email", "local_phone", "iban", "ssn")
_LABELERS = ("format", "gazetteer", "context")

#: Each pattern takes what a leftmost search for the kind takes. Starts are anchored to the start of a run, or to the end of
#: the match before, so that a search is linear in the text; \G is where the match before ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "spoken_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,64}+(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z]{2,24}",
    "local_phone": r"(?<![0-9+().-])(?<![0-9+().-] )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![ .-]?[0-9])",
    "iban": r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: What a text must hold for a kind to be searched at all.
_HINTS = {
    "email": "@", "ip": ".", "card": None, "phone": "+", "spoken_email": "at", "local_phone": None, "iban": None, "ssn": "-",
}

#: Gazetteers.
_TOP_DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|ch|at|nl|be|pl|pt|se|dk|no|fi|jp|cn|in|br|mx|ca|au|us|ru"
_ROLE_ACCOUNTS = "noreply|no-reply|donotreply|info|support|admin|webmaster|postmaster|sales|help|contact|abuse"
_RESERVED_NETWORKS = r"0\.|10\.|127\.|169\.254\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|22[4-9]\.|23[0-9]\.|255\."
_ISSUERS = r"4|5[1-5]|2[2-7]|3[47]|35|36|6011|64|65|62"
_CALLING_CODES = "1|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58]"
_IBAN_COUNTRIES = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|SE"
#: Words before a span that speak for it, and that speak against it.
_FOR = {
    "email": "mail|contact|write|reach|from|to", "ip": "ip|host|address|client|login|server", "card": "card|visa|pay|credit|debit|account",
    "phone": "phone|call|tel|mobile|fax|contact|whatsapp", "spoken_email": "mail|contact|write|reach", "local_phone": "phone|call|tel|mobile|fax|contact",
    "iban": "iban|account|bank|transfer", "ssn": "ssn|social|security",
}
_AGAINST = {
    "email": "example|sample", "ip": "version|release|section|v", "card": "order|isbn|serial|tracking|invoice|id", "phone": "order|isbn|serial|equation",
    "spoken_email": "look", "local_phone": "order|isbn|serial|part", "iban": "model|part|serial", "ssn": "order|isbn|part|model",
}


def matches(text: Column, pattern: str) -> Column:
    """Non-overlapping matches from the left, as array<struct<start,end,value>> in code points."""

    def placed(parts: Column) -> Column:
        found = F.zip_with(F.slice(parts["gaps"], 1, F.size(parts["values"])), parts["values"],
                           lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))

        def spans(items: Column) -> Column:
            offsets = running(F.transform(items, lambda x: x["gap"] + F.length(x["value"])))
            return F.zip_with(items, offsets, lambda x, o: F.struct(
                (o + x["gap"]).alias("start"), (o + x["gap"] + F.length(x["value"])).alias("end"), x["value"].alias("value")))

        return F.when(F.size(parts["values"]) > 0, let(found, spans)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))

    return let(F.struct(F.regexp_extract_all(text, F.lit(pattern), 0).alias("values"), F.split(text, pattern, -1).alias("gaps")), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """What a match of a base kind must meet; a match that does not is dropped."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))))
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def candidates(text: Column) -> Column:
    """All spans proposed in a text: array<struct<kind,start,end,value,left,right>>, by kind, then start."""

    def of_kind(kind: str) -> Column:
        held = F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
        spans = F.transform(held, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].cast("long").alias("start"), m["end"].cast("long").alias("end"), m["value"].alias("value"),
            F.substring(text, F.greatest(m["start"] - 39, F.lit(1)), F.least(m["start"], F.lit(40))).alias("left"),
            F.substring(text, m["end"] + 1, F.lit(12)).alias("right")))
        hint = _HINTS[kind]
        has = text.contains(hint) if hint else text.rlike("[0-9]")
        if kind not in ("email", "spoken_email") and hint:
            has = has & text.rlike("[0-9]")
        none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string,left:string,right:string>>")
        return F.when(has, spans).otherwise(none)

    return F.flatten(F.array(*map(of_kind, KINDS)))


def _by_kind(span: Column, per_kind: dict[str, Column]) -> Column:
    out = F.lit(0)
    for kind, vote in per_kind.items():
        out = F.when(span["kind"] == kind, vote).otherwise(out)
    return out


def _yes_no(yes: Column, no: Column | None = None) -> Column:
    """1 for yes, -1 for no, 0 for nothing; without ``no``, what is not yes is no."""
    return F.when(yes, 1).when(~yes if no is None else no, -1).otherwise(0)


def votes(span: Column) -> list[Column]:
    value, left = span["value"], F.lower(span["left"])
    format_ = _by_kind(span, {
        "email": _yes_no(value.rlike(r"^[A-Za-z0-9][^@]*@[^@]*[A-Za-z0-9]\.[A-Za-z]{2,24}$") & ~value.contains("..")),
        "ip": _yes_no(~value.rlike(r"(?:^|\.)0[0-9]")),
        "card": _yes_no(value.rlike(r"^(?:[0-9]{16,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$")),
        "phone": _yes_no(F.length(_digits(value)).between(10, 13)),
        "spoken_email": _yes_no(value.rlike(r"[\[(] ?dot ?[\])]|\.(?:com|org|net)$")),
        "local_phone": _yes_no(value.rlike(r"^\([2-9]|^[2-9][0-9]{2}([ .-])[0-9]{3}\1")),
        "iban": _yes_no(F.length(F.regexp_replace(value, " ", "")).between(15, 31)),
        "ssn": _yes_no(~value.rlike("^(?:000|666|9)|-00-|-0000$")),
    })
    gazetteer = _by_kind(span, {
        "email": _yes_no(F.lower(value).rlike(rf"\.(?:{_TOP_DOMAINS})$") & ~F.lower(value).rlike(f"^(?:{_ROLE_ACCOUNTS})@"), F.lower(value).rlike(f"^(?:{_ROLE_ACCOUNTS})@")),
        "ip": _yes_no(~value.rlike(f"^(?:{_RESERVED_NETWORKS})")),
        "card": _yes_no(value.rlike(f"^(?:{_ISSUERS})")),
        "phone": _yes_no(_digits(value).rlike(f"^(?:{_CALLING_CODES})")),
        "spoken_email": _yes_no(F.lower(value).rlike(f"(?:{_TOP_DOMAINS})$")),
        "iban": _yes_no(value.rlike(f"^(?:{_IBAN_COUNTRIES})")),
    })
    context = _by_kind(span, {
        k: _yes_no(left.rlike(rf"\b(?:{_FOR[k]})\w{{0,8}}\W[^.!?\n]*$"), left.rlike(rf"\b(?:{_AGAINST[k]})\w{{0,3}}\W{{1,3}}$")) for k in KINDS})
    return [format_, gazetteer, context]


def described(span: Column) -> Column:
    """Votes and features of a span as small integers."""
    touches = (span["left"].rlike("[A-Za-z0-9]$")).cast("int") + (span["right"].rlike("^[A-Za-z0-9]")).cast("int")
    length = F.least(F.lit(5), F.floor((span["end"] - span["start"]) / 8)).cast("int")
    parts = (F.size(F.split(span["value"], "[^A-Za-z0-9]+")) - 1).cast("int")
    named = zip(_LABELERS, votes(span), strict=True)
    return F.struct(*(v.cast("int").alias(n) for n, v in named), length.alias("length"), touches.alias("touches"), F.least(parts, F.lit(5)).alias("parts"))


@dataclass(frozen=True)
class Aggregation:
    """What EM found: per labeler the chance that its vote is right, per kind the share of true spans."""

    reliability: dict[str, float]
    share: dict[str, float]
    posterior: np.ndarray


def aggregate_votes(kinds: list[str], vote: np.ndarray, n: np.ndarray, rounds: int = 50) -> Aggregation:
    """Two-class EM over counted vote vectors, labelers independent given the truth, abstentions saying nothing.

    Reliabilities start at 0.8 and shares at 0.9, with a weak prior at these values, so that a labeler with few votes and a
    kind with few spans stay near them and the truth does not change sides.
    """
    right, share, posterior = np.full(vote.shape[1], 0.8), {k: 0.9 for k in set(kinds)}, np.full(len(kinds), 0.9)
    index = {k: np.array([x == k for x in kinds]) for k in share}
    for _ in range(rounds):
        prior = np.array([share[k] for k in kinds])
        odds = np.log(prior / (1 - prior)) + vote @ np.log(right / (1 - right))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        agrees = np.where(vote > 0, posterior[:, None], 1 - posterior[:, None]) * (vote != 0) * n[:, None]
        right = np.clip((agrees.sum(0) + 8) / (((vote != 0) * n[:, None]).sum(0) + 10), 0.55, 0.99)
        share = {k: float(np.clip(((posterior * n)[at].sum() + 9) / (n[at].sum() + 10), 0.02, 0.98)) for k, at in index.items()}
    return Aggregation(dict(zip(_LABELERS, right.tolist(), strict=True)), share, posterior)


def _row(kind: str, d: dict) -> list[float]:
    return [1.0, *(float(kind == k) for k in KINDS), *(float(d[v]) for v in _LABELERS), d["length"] / 5, d["touches"] / 2, d["parts"] / 5]


def train(docs: DataFrame) -> list[float]:
    """Weights of the span classifier from all spans of the corpus, on counts per vector."""
    span = F.explode(candidates(text_of(docs)))
    spans = docs.select(span.alias("s")).select("s.kind", described(F.col("s")).alias("d"))
    counted = spans.groupBy("kind", "d").count().orderBy("kind", "d").collect()  # bounded by the product of the value ranges
    kinds, rows = [r["kind"] for r in counted], [r["d"].asDict() for r in counted]
    n = np.array([r["count"] for r in counted], float)
    width = len(KINDS) + len(_LABELERS) + 4
    weights = np.zeros(width)
    if not kinds:
        return weights.tolist()
    soft = aggregate_votes(kinds, np.array([[d[v] for v in _LABELERS] for d in rows], float), n).posterior
    x = np.array([_row(k, d) for k, d in zip(kinds, rows, strict=True)])
    for _ in range(40):  # Newton steps on the weighted logistic loss with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (p - soft)) / n.sum() + 1e-4 * weights
        curvature = (x * (n * p * (1 - p))[:, None]).T @ x / n.sum() + 1e-4 * np.eye(width)
        step = np.linalg.solve(curvature, gradient)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return weights.tolist()


def chance(span: Column, weights: list[float]) -> Column:
    """The classifier's chance that a span is personal data."""
    bias, *rest = weights
    by_kind, by_vote, (length, touches, parts) = rest[: len(KINDS)], rest[len(KINDS) : -3], rest[-3:]

    def total(d: Column) -> Column:
        kind = F.lit(0.0)
        for k, w in zip(KINDS, by_kind, strict=True):
            kind = F.when(span["kind"] == k, w).otherwise(kind)
        vote = sum((d[v] * w for v, w in zip(_LABELERS, by_vote, strict=True)), F.lit(bias))
        return kind + vote + d["length"] * (length / 5) + d["touches"] * (touches / 2) + d["parts"] * (parts / 5)

    return 1 / (1 + F.exp(-let(described(span), total)))


def with_personal_data(docs: DataFrame, column: str, least: float = 0.5) -> DataFrame:
    """All rows and columns of ``docs`` and, as ``column``, array<struct<kind,start,end,chance>> for the whole of ``text``.

    Spans of the base kinds (email, ip, card, phone) are all reported; of the further kinds, those with a chance of at
    least ``least``. Order: kind as in KINDS, then start; code points, end exclusive. Spans of different kinds may overlap.
    NULL and empty texts have no spans. Repeated rows count in the fit as often as they occur and get equal spans. A corpus
    without any span, or an empty table, fits nothing and reports nothing. Further columns pass through.
    """
    weights = train(docs)
    found = spare(docs, "pii_found")
    least_odds = F.lit(least)
    scored = F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), chance(s, weights).alias("chance")))
    held = F.filter(scored, lambda s: s["kind"].isin(*BASE_KINDS) | (s["chance"] >= least_odds))
    return docs.withColumn(found, candidates(text_of(docs))).withColumn(column, held).drop(found)


def redact(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The same rows and columns with each span in ``text`` replaced by its kind in angle brackets; NULL stays NULL."""
    found = spare(docs, "pii_spans")
    marked = with_personal_data(docs, found, least)
    text = F.col("text")
    by_start = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        parts = F.concat(state["done"], F.array(gap, F.concat(F.lit("<"), s["kind"], F.lit(">"))))
        fresh = s["start"] >= state["at"]
        return F.struct(F.when(fresh, parts).otherwise(state["done"]).alias("done"), F.greatest(state["at"], s["end"]).alias("at"))

    joined = F.aggregate(by_start, start, step, lambda s: F.concat(F.array_join(s["done"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    return marked.withColumn("text", F.when(F.size(found) > 0, joined).otherwise(text)).drop(found)
