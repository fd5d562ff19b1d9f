"""Personal data: weak-supervision labelers, expectation-maximisation and a final span classifier."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import let, stage, text_id

KINDS = ["email", "ip", "card", "phone"]
LOCAL = "[A-Za-z0-9._%+-]"

# The base patterns, in a form that never looks twice at a run of characters: possessive, and started
# only where a run starts or where the last match ended.  They match what the plain forms match.
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a run with fewer than 12 digits would be dropped, and so would any part of it
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates, which count only if they pass the same checks and the classifier accepts them:
# written-out addresses, and numbers that the base pattern runs together with a neighbour and drops.
EXTRA = {
    "email": rf"(?i)(?<!{LOCAL}){LOCAL}++\x20?[\[(](?:at|@)[\])]\x20?[A-Z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|\.)[\])]\x20?)[A-Z0-9-]++)++",
    "card": r"(?<![0-9A-Za-z.+-])(?:[0-9]{12,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9A-Za-z]|[.-][0-9])",
    "phone": r"\+(?:1[\x20.-]?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}|[2-9][0-9]{0,2}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-][0-9]{2,4}){1,4})(?![0-9])",
}
HINT = {"email": "@", "phone": "+"}  # a text without it cannot match the base pattern

# Word lists of the context labeler, in English, German, French and Spanish.
CONTEXT = {
    "email": "e-?mails?|mail|mailto|contact|contacto|kontakt|courriel|correo|schreib\\w*|write",
    "ip": "ip|ips|host|hosts|server|servers|serveur|servidor|address|adresse|login|client|gateway",
    "card": "card|cards|visa|mastercard|amex|credit|kreditkarte|karte|carte|tarjeta|payment|zahlung",
    "phone": "phone|phones|tel|telephone|telefon|téléphone|teléfono|mobile|handy|call|fax|anruf|appelez|llame",
}
AGAINST = "version|release|v|isbn|issn|order|sku|token|hash|commit|sha|key|id|ref|section|chapter|build|invoice|doi"
# Gazetteers of top-level domains, issuer prefixes, calling codes and special address blocks.
DOMAINS = "com|org|net|edu|gov|int|info|io|eu|uk|us|de|at|ch|fr|be|es|mx|ar|it|nl|pt|br|pl|se|no|dk|fi|ru|cn|jp|in|au|ca"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|3[068]|35"
CALLING = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[0-9]|37[0-9]|38[0-9]|42[0-3]|85[0-6]|97[0-9]"
SPECIAL = r"^(0|127|255|22[4-9]|23[0-9])\."

LABELERS = ["format", "gazetteer", "context", "boundary"]
ABSTAIN, NO, YES = 0, 1, 2


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the check sum."""
    backward = F.rpad(F.reverse(digits), 19, "0")
    total = F.lit(0)
    for i in range(19):
        digit = F.substring(backward, i + 1, 1).cast("int")
        total = total + (digit if i % 2 == 0 else digit * 2 - F.when(digit > 4, 9).otherwise(0))
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """The checks of the base: octets, digit counts, check sum."""
    octet = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    count = F.length(_digits(value))
    return (
        F.when(kind == "ip", value.rlike(rf"^({octet}\.){{3}}{octet}$"))
        .when(kind == "card", count.between(12, 19) & luhn(_digits(value)))
        .when(kind == "phone", count.between(9, 15))
        .otherwise(True)
    )


def _found(body: Column, pattern: str) -> Column:
    """Matches in order, each with the length of the gap before it and the text around."""
    def described(between: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(body, F.lit(pattern), 0),
            lambda m, i: F.struct(
                i.alias("nth"),
                F.length(F.get(between, i)).alias("gap"),
                m.alias("value"),
                F.substring(F.get(between, i), -48, 48).alias("before"),
                F.substring(F.get(between, i + 1), 1, 8).alias("after"),
            ),
        )

    return let(F.split(body, pattern, -1), described)


def candidates(rows: DataFrame) -> DataFrame:
    """Every match in texts (_id, _body): _id, _text, kind, base, start, end, value, before, after, valid."""
    columns = []
    for base, patterns in ((True, BASE), (False, EXTRA)):
        for kind, pattern in patterns.items():
            body = F.col("_body")
            possible = body.contains(HINT[kind]) if base and kind in HINT else body.rlike(pattern)
            columns.append(
                F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), F.when(possible, _found(body, pattern)).alias("found"))
            )
    listed = rows.select("_id", text_id(F.col("_body")).alias("_text"), F.explode(F.array(*columns)).alias("by"))
    matches = listed.select("_id", "_text", "by.kind", "by.base", F.explode_outer("by.found").alias("m")).where("m is not null")
    matches = matches.select("_id", "_text", "kind", "base", "m.*").dropDuplicates(["_id", "_text", "kind", "base", "nth"])
    in_order = Window.partitionBy("_id", "_text", "kind", "base").orderBy("nth")
    past = F.sum(F.col("gap") + F.length("value")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return matches.select(
        "_id", "_text", "kind", "base",
        (past - F.length("value")).alias("start"),
        past.alias("end"),
        "value", "before", "after",
        _valid(F.col("kind"), F.col("value")).alias("valid"),
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, NO).when(yes, YES).otherwise(ABSTAIN)


def votes(spans: DataFrame) -> DataFrame:
    """`spans` with one vote per labeler: yes, no or abstain."""
    kind, value = F.col("kind"), F.col("value")
    digits, before = _digits(value), F.lower("before")
    own_context = F.lit(False)
    for k, listed in CONTEXT.items():
        own_context = F.when(kind == k, before.rlike(rf"(?<![\p{{L}}\p{{N}}])({listed})[^\p{{L}}\p{{N}}]*(\p{{L}}+[^\p{{L}}\p{{N}}]+){{0,3}}$")).otherwise(own_context)
    against = before.rlike(rf"(?<![\p{{L}}\p{{N}}])({AGAINST})[^\p{{L}}\p{{N}}]*$")
    touching = F.col("before").rlike(r"[\p{L}\p{N}_/=-]$") | F.col("after").rlike(r"^[\p{L}\p{N}_/=-]")
    plain = F.regexp_replace(F.lower(value), r"\x20?[\[(](dot|\.)[\])]\x20?", ".")
    return spans.withColumns(
        {
            "format": _vote(F.col("valid"), ~F.col("valid")),
            "gazetteer": F.when(kind == "email", _vote(plain.rlike(rf"\.({DOMAINS})$"), plain.rlike(r"\.[0-9-]+$")))
            .when(kind == "ip", _vote(F.lit(False), value.rlike(SPECIAL)))
            .when(kind == "card", _vote(digits.rlike(f"^({ISSUERS})"), digits.rlike("^0")))
            .otherwise(_vote(F.regexp_replace(digits, "^00", "").rlike(f"^({CALLING})"), digits.rlike("^000|^0+$"))),
            "context": _vote(own_context, against),
            "boundary": _vote(~touching, touching),
        }
    )


def estimate(
    patterns: list[tuple[str, tuple[int, ...], int]], known: list[float | None] | None = None, rounds: int = 200
) -> tuple[dict, list[float]]:
    """Expectation-maximisation over vote patterns: (kind, votes, count) of every pattern seen.

    Labelers vote independently given the truth; one that abstains says nothing.  Estimated are the
    share of true spans per kind and, per labeler, the chance of a yes on true and on false spans.
    `known` fixes the truth of some patterns.  Returns reliabilities (labeler -> those two chances)
    and the posterior of each pattern.
    """
    known = known or [None] * len(patterns)
    guess = [0.5 + 0.4 * (sum(v == YES for v in votes) - sum(v == NO for v in votes)) / len(LABELERS) for _, votes, _ in patterns]
    truth = [g if k is None else k for g, k in zip(guess, known)]
    chances: dict[str, tuple[float, float]] = {}
    for _ in range(rounds):
        share = {}
        for kind in {k for k, _, _ in patterns}:
            of_kind = [(n, t) for (k, _, n), t in zip(patterns, truth) if k == kind]
            share[kind] = (1 + sum(n * t for n, t in of_kind)) / (2 + sum(n for n, _ in of_kind))
        for i, name in enumerate(LABELERS):
            cast = [(votes[i] == YES, n, t) for (_, votes, n), t in zip(patterns, truth) if votes[i] != ABSTAIN]
            # a prior of 16 votes at 3 in 4 right keeps the meaning of yes and no
            on_true = (12 + sum(n * t for yes, n, t in cast if yes)) / (16 + sum(n * t for _, n, t in cast))
            on_false = (4 + sum(n * (1 - t) for yes, n, t in cast if yes)) / (16 + sum(n * (1 - t) for _, n, t in cast))
            chances[name] = (on_true, on_false)
        before, truth = truth, []
        for (kind, votes, _), fixed in zip(patterns, known):
            if fixed is not None:
                truth.append(fixed)
                continue
            odds = math.log(share[kind] / (1 - share[kind]))
            for name, vote in zip(LABELERS, votes):
                if vote != ABSTAIN:
                    a, b = chances[name]
                    odds += math.log(a / b) if vote == YES else math.log((1 - a) / (1 - b))
            truth.append(1 / (1 + math.exp(-max(-50.0, min(50.0, odds)))))
        if max((abs(a - b) for a, b in zip(before, truth)), default=0) < 1e-9:
            break
    return chances, truth


def feature_names() -> list[tuple[str, object]]:
    names: list[tuple[str, object]] = [("kind", k) for k in KINDS] + [("base", False)]
    return names + [(name, vote) for name in LABELERS for vote in (NO, YES)]


def fit_classifier(rows: list[dict], counts: list[int], truth: list[float], ridge: float = 1.0) -> list[float]:
    """Weights of a logistic regression on span features against the posteriors, by Newton steps."""
    x = np.array([[float(r[name] == value) for name, value in feature_names()] for r in rows])
    n, t = np.array(counts, dtype=float), np.array(truth)
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (t - p)) - ridge * weights
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return [float(w) for w in weights]


def _chance(weights: list[float]) -> Column:
    total = F.lit(0.0)
    for (name, value), weight in zip(feature_names(), weights):
        total = total + F.when(F.col(name) == value, weight).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def find_spans(rows: DataFrame, accept: float = 0.5) -> DataFrame:
    """Spans of texts (_id, _body): _id, _text, kind, start, end, value, base, chance.

    base: a valid match of a base pattern, which always stays.  Any other candidate stays if it passes
    the checks of its kind, the classifier gives it at least `accept` and no base span overlaps it.
    """
    spans = stage(votes(candidates(rows)), "pii-candidates")
    keys = ["kind", "base", *LABELERS]
    table = sorted((r.asDict() for r in spans.groupBy(*keys).count().collect()), key=lambda r: tuple(r[k] for k in keys))
    # the driver sees one row per kind and vote pattern: 648 at most
    patterns = [(r["kind"], tuple(r[k] for k in LABELERS), r["count"]) for r in table]
    # a match of the base that passes its checks is a span, a candidate that fails them is none
    known = [0.0 if r["format"] == NO else 1.0 if r["base"] else None for r in table]
    _, truth = estimate(patterns, known)
    weights = fit_classifier(table, [r["count"] for r in table], truth) if table else [0.0] * len(feature_names())
    sure = F.col("base") & F.col("valid")
    kept = spans.withColumn("chance", _chance(weights)).where(sure | (F.col("valid") & (F.col("chance") >= accept)))
    kept = kept.withColumn("sure", sure)
    # furthest end of base spans that start before, nearest start of those after
    near = Window.partitionBy("_id", "_text")
    ends = F.max(F.when(F.col("sure"), F.col("end"))).over(near.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    starts = F.min(F.when(F.col("sure"), F.col("start"))).over(near.orderBy("start").rangeBetween(0, Window.unboundedFollowing))
    free = F.coalesce(ends <= F.col("start"), F.lit(True)) & F.coalesce(starts >= F.col("end"), F.lit(True))
    return (
        kept.withColumns({"_free": free})
        .where(F.col("sure") | F.col("_free"))
        .select("_id", "_text", "kind", "start", "end", "value", F.col("sure").alias("base"), "chance")
        .dropDuplicates(["_id", "_text", "kind", "start", "end"])
    )


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and base_sha256 are those of the base spans, written kind:start:end (code points, end
    exclusive), by start and then kind, comma-joined; spans lists these and the added ones likewise.

    Regex, gazetteer, context and boundary labelers vote on every candidate.  Expectation-maximisation
    over the counts of vote patterns estimates how reliable each is; its posteriors train a logistic
    regression, which runs as a column expression and accepts or refuses candidates beside the base.

    Null texts count as empty, and both have no spans.  Repeated rows and null ids are rows of their
    own; an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_body"))
    spans = find_spans(rows)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    entry = F.struct("start", rank.alias("rank"), "end", F.concat_ws(":", "kind", "start", "end").alias("said"))
    joined = lambda entries: F.array_join(F.transform(F.array_sort(entries), lambda e: e["said"]), ",")
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS]
    lists = spans.groupBy("_id", "_text").agg(
        *counts,
        joined(F.collect_list(F.when(F.col("base"), entry))).alias("base_spans"),
        joined(F.collect_list(entry)).alias("spans"),
        F.count(F.when(~F.col("base"), 1)).alias("n_added"),
    )
    lists = stage(lists.withColumnsRenamed({"_id": "_s_id", "_text": "_s_text"}), "pii-spans")
    base = rows.select(F.col("_id").alias("doc_id"), text_id(F.col("_body")).alias("_text"))
    same = base["doc_id"].eqNullSafe(lists["_s_id"]) & (base["_text"] == lists["_s_text"])
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return base.join(lists, same, "left").select(
        "doc_id",
        *[zero(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base_spans", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        zero("n_added"),
    )
