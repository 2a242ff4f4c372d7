"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them,
and a span classifier trained on the result decides.

Candidates are the matches of each kind's base pattern, kept or failed, and of a wider pattern
(numbers beside other numbers, national phone forms, other separators, spelt-out addresses).
Six labelers vote 1, -1 or 0 (abstain) on each: base pattern, validity (checksum, ranges),
gazetteers (top-level domains, calling codes, issuers, address ranges), cue words before the span, words before
it that name something else, and shape. Votes are counted per kind and combination of votes (at most
`4 * 3 ** 6` rows); on these counts EM estimates how each labeler votes on true and on false spans.
The classifier adds what the labelers do not see: log odds of the word before, of the shape and
of what follows, trained on the posteriors of all candidates, in a table of a bounded number of hashed rows.

Base spans always stay. A wide candidate is added if it is valid, its score is at least one half,
and it overlaps neither a base span nor an added span of a kind listed before its own.

Only DataFrame functions are used; texts are read once, in place, and only spans are stored.
Patterns are written so that they never backtrack over a run (possessive, starting where a run
starts), so a text of any length takes time in proportion to its length and no stack.

Defined results: NULL and empty texts have no spans, and the hash of nothing; repeated rows and NULL ids
give a row each; equal starts are ordered by kind; an empty table gives an empty result;
columns other than doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm.common import text_of
from sparkrec.session import durable

KINDS = ("email", "ip", "card", "phone")
FAILED, WIDE, BASE = -1, 0, 1

# The base patterns of the contract, in a form that reads each run once.
BASE_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"\x20?(?:@|\[at\]|\(at\)|\{at\})\x20?"
_DOT = r"(?:\.|\x20?(?:\[dot\]|\(dot\)|\{dot\})\x20?|\x20dot\x20)"
_LABEL = r"[A-Za-z0-9-]++"
_HEX = r"[0-9A-Fa-f]{1,4}"
_SEP = r"[\x20._/–-]"
WIDE_PATTERNS = {
    "email": rf"(?i)(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:{_AT}{_LABEL}(?:{_DOT}{_LABEL})++|\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL})++)",
    "ip": rf"(?i)(?<![0-9A-Za-z:.])(?:[0-9]{{1,3}}(?:(?:\x20?\[\.\]\x20?|\x20?\(\.\)\x20?|\[dot\]|\x20dot\x20)[0-9]{{1,3}}){{3}}"
          rf"|(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}(?::{_HEX}){{1,5}})(?![0-9A-Za-z:])",
    "card": rf"(?<![0-9A-Za-z])(?:[0-9]{{12,19}}|[0-9]{{4}}{_SEP}{{1,2}}[0-9]{{6}}{_SEP}{{1,2}}[0-9]{{5}}"
            rf"|[0-9]{{4}}(?:{_SEP}{{1,2}}[0-9]{{4}}){{2,3}}(?:{_SEP}{{1,2}}[0-9]{{1,3}})?)(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
             r"|(?:\+|00)[1-9][0-9]{0,2}(?:[ ./-]?\(0\))?(?:[ ./-]?\(?[0-9]{1,4}\)?){2,6}"
             r"|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
             r"|0[1-9]([ .-])[0-9]{2}(?:\1[0-9]{2}){3}"
             r"|0[1-9][0-9]{1,3}(?:[ ./-][0-9]{2,8}){1,4})(?![0-9A-Za-z])",
}

# Gazetteers and cue words, in the languages of the corpus.
DOMAINS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "dev", "app", "eu", "de", "at", "ch", "fr", "be",
           "es", "mx", "ar", "it", "nl", "uk", "us", "ca", "au", "jp", "cn", "in", "br", "pl", "se", "no", "dk", "fi", "pt", "ru")
CALLING_CODES = r"^(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(?:4[0-9]{12}(?:[0-9]{3}){0,2}|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|3[0689][0-9]{12}|35[0-9]{14}|6(?:011|4[4-9]|5)[0-9]{12,13})$"
CUES = {
    "email": r"e-?mail|mail|contact|correo|courriel|adresse|write to|reply",
    "ip": r"ip|host|server|address|adresse|client|dirección|login",
    "card": r"card|credit|visa|mastercard|amex|carte|karte|tarjeta|payment|iban",
    "phone": r"phone|tel|telephone|téléphone|teléfono|telefon|call|fax|mobile|cell|handy|móvil|portable|contact|whatsapp",
}
OTHER_THINGS = r"version|v|isbn|issn|doi|order|invoice|section|chapter|page|figure|ref|id|sku|sha|hash|token|key|commit|build|licen[cs]e|article"

STRENGTH = 20.0  # pseudo-observations behind each labeler
VOTES = (-1, 0, 1)
PRIOR = {1: (0.1, 0.4, 0.5), 0: (0.5, 0.4, 0.1)}  # of votes -1, 0, 1 on true and on false spans
ROUNDS, STEADY = 25, 1e-4
FEATURE_ROWS = 4096  # hashed rows per feature and kind
FEATURE_LIMIT = 2.0
LABELERS = ("by_pattern", "by_rule", "by_list", "by_cue", "by_other", "by_shape")
FEATURES = ("word", "shape", "after")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is reckoned once, however often `body` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(steps: Column, block: int = 64) -> Column:
    """Sums of an array up to each place, by sums of blocks."""
    def added(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, b: a + b)

    def within(s: Column) -> Column:
        places = F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(F.array().cast("array<int>"))
        whole = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(s), 6)), lambda b: added(F.slice(s, 1, b * block)))
        return let(whole, lambda w: F.transform(places, lambda i: F.element_at(w, F.shiftright(i, 6) + 1) + added(
            F.slice(s, i - i % block + 1, i % block + 1))))

    return let(steps, within)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches as structs (start, end, value, left, right); code points, end exclusive."""
    rule, empty = F.lit(pattern), F.array().cast("array<struct<start:int,end:int,value:string,left:string,right:string>>")

    def placed(found: Column, gaps: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.length(F.element_at(gaps, i + 1)) + F.when(
            i > 0, F.length(F.get(found, i - 1))).otherwise(0))
        return let(running_sums(steps), lambda starts: F.transform(found, lambda m, i: F.struct(
            F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(m)).alias("end"), m.alias("value"),
            F.right(F.get(gaps, i), F.lit(40)).alias("left"), F.left(F.get(gaps, i + 1), F.lit(16)).alias("right"))))

    return let(F.regexp_extract_all(text, rule, 0), lambda found: F.when(F.size(found) == 0, empty).otherwise(
        let(F.split(text, rule, -1), lambda gaps: placed(found, gaps))))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does a string of up to 19 digits pass the checksum?"""
    doubled = F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    total = let(F.reverse(digits), lambda rev: F.aggregate(
        F.sequence(F.lit(1), F.length(rev)), F.lit(0), lambda a, i: a + let(
            F.ascii(F.substring(rev, i, F.lit(1))) - 48, lambda d: F.when(i % 2 == 0, F.element_at(doubled, d + 1)).otherwise(d))))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The rule a match of this kind has to meet besides its pattern."""
    digits = digits_of(value)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return ~F.exists(F.split(value, r"[^0-9A-Fa-f:]+"), lambda p: ~p.contains(":") & (p != "") & ~p.rlike(
            "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    n = F.length(digits)
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), luhn(digits)).otherwise(False)


def _candidates(text: Column, kind: str) -> Column:
    """All candidates of a kind, with `tier`: kept or failed by the base pattern, or wide."""
    at = F.lit(KINDS.index(kind))

    def tiered(m: Column, tier: Column) -> Column:
        return F.struct(m["start"].alias("start"), at.alias("kind"), m["end"].alias("end"), m["value"].alias("value"),
                        m["left"].alias("left"), m["right"].alias("right"), tier.alias("tier"))

    base = F.transform(matches(text, BASE_PATTERNS[kind]), lambda m: tiered(
        m, F.when(valid(kind, m["value"]), BASE).otherwise(FAILED)))
    wide = F.transform(matches(text, WIDE_PATTERNS[kind]), lambda m: tiered(m, F.lit(WIDE)))

    def joined(b: Column) -> Column:
        # a wide match that is a base match says nothing new
        places = F.transform(b, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
        return let(places, lambda known: F.concat(b, F.filter(wide, lambda m: ~F.array_contains(
            known, F.struct(m["start"].alias("start"), m["end"].alias("end"))))))

    return let(base, joined)


def candidates(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, found): the candidates of every document; texts stay where they are."""
    text = text_of()
    some = F.array().cast("array<struct<start:int,kind:int,end:int,value:string,left:string,right:string,tier:int>>")
    # a text without a digit or an @ has spelt-out addresses at most
    found = F.concat(*[F.when(text.rlike(r"[0-9@]|(?i)[\[({\x20]at[\])}\x20]"), _candidates(text, k)).otherwise(some) for k in KINDS])
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), found.alias("found"))


def _per_kind(build: Callable[[str], Column]) -> Column:
    out = F.lit(None)
    for at, kind in enumerate(KINDS):
        out = F.when(F.col("kind") == at, build(kind)).otherwise(out)
    return out


def _listed(kind: str) -> Column:
    value, digits = F.col("value"), digits_of(F.col("value"))
    if kind == "email":
        return F.when(F.lower(F.regexp_extract("value", r"([A-Za-z]+)$", 1)).isin(*DOMAINS), 1).otherwise(0)
    if kind == "phone":
        return F.when(value.rlike(CALLING_CODES), 1).otherwise(0)
    if kind == "card":
        return F.when(digits.rlike(ISSUERS), 1).otherwise(-1)
    first = F.regexp_extract("value", r"^0*([0-9]{1,3})(?![0-9])", 1).try_cast("int")
    return F.when(first.between(1, 223), 1).when(first.isNotNull(), -1).otherwise(0)


def _shaped(kind: str) -> Column:
    glued = F.col("left").rlike("[0-9A-Za-z_]$") | F.col("right").rlike("^[0-9A-Za-z_]")
    usual = {
        "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\x20?[@\[({a]", "ip": r"^[0-9]{1,3}[^0-9]+[0-9]{1,3}[^0-9]+[0-9]{1,3}[^0-9]+[0-9]{1,3}$|:",
        "card": r"^(?:[0-9]{13,16}|[0-9]{4}(?:[^0-9]+[0-9]{4}){3}|[0-9]{4}[^0-9]+[0-9]{6}[^0-9]+[0-9]{5})$",
        "phone": r"^(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}$"}[kind]
    return F.when(glued, -1).when(F.col("value").rlike(usual), 1).otherwise(0)


def labelled(found: DataFrame) -> DataFrame:
    """One row per candidate with the votes of the labelers and the features of the classifier."""
    each = found.select("rid", F.explode("found").alias("c")).select("rid", "c.*")
    rule = _per_kind(lambda k: valid(k, F.col("value")) & (
        F.col("value").rlike(r"(?:^|[^A-Za-z0-9])[A-Za-z]{2,24}$") if k == "email" else F.lit(True)))
    cue = _per_kind(lambda k: F.col("left").rlike(rf"(?i)(?:^|[^\p{{L}}])(?:{CUES[k]})[^\p{{L}}]"))
    other = F.col("left").rlike(rf"(?i)(?:^|[^\p{{L}}])(?:{OTHER_THINGS})[^\p{{L}}0-9]{{0,4}}$")
    votes = {
        "by_pattern": F.col("tier"), "by_rule": F.when(rule, 1).otherwise(-1), "by_list": _per_kind(_listed),
        "by_cue": F.when(cue, 1).otherwise(0), "by_other": F.when(other, -1).otherwise(0), "by_shape": _per_kind(_shaped),
    }
    seen = {
        "word": F.lower(F.regexp_extract("left", r"(\p{L}+)[^\p{L}]*$", 1)),
        "shape": F.substring(F.regexp_replace(F.regexp_replace("value", "[0-9]", "9"), r"\p{L}+", "a"), 1, 24),
        "after": F.substring(F.regexp_replace("right", r"\p{L}+", "a"), 1, 3),
    }
    return each.select(
        "rid", "kind", "start", "end", "tier", *[v.cast("int").alias(n) for n, v in votes.items()],
        *[F.pmod(F.xxhash64(v), F.lit(FEATURE_ROWS)).cast("int").alias(n) for n, v in seen.items()])


def _start() -> tuple[list[float], list[float]]:
    """Log odds of the kinds, and of each vote of each labeler per kind, before any count."""
    return [0.0] * len(KINDS), [math.log(PRIOR[1][v] / PRIOR[0][v]) for _ in KINDS for _ in LABELERS for v in range(3)]


def vote_odds(prior: list[float], weights: list[float]) -> Column:
    """Log odds that a candidate is personal data, by its votes."""
    table, kind = F.array(*[F.lit(w) for w in weights]), F.col("kind")
    odds = F.element_at(F.array(*[F.lit(p) for p in prior]), kind + 1)
    for j, name in enumerate(LABELERS):
        odds = odds + F.element_at(table, (kind * len(LABELERS) + j) * 3 + F.col(name) + 2)
    return odds


def chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(30.0)), F.lit(-30.0))))


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[list[float], list[float]]:
    """EM over counts of vote combinations (kind, votes, n): log odds of the kinds and of the votes.

    The sums of a round are at most one row per kind, labeler and vote.
    """
    prior, weights = _start()
    votes = F.array(*[F.col(c) for c in LABELERS])
    for _ in range(rounds):
        expected = patterns.withColumn("p", chance(vote_odds(prior, weights)))
        sums = expected.select("kind", "n", "p", F.posexplode(votes).alias("labeler", "vote")).groupBy("kind", "labeler", "vote").agg(
            F.sum(F.col("n") * F.col("p")).alias("true"), F.sum(F.col("n") * (1 - F.col("p"))).alias("false")).collect()
        got = {(r.kind, r.labeler, r.vote): (r.true, r.false) for r in sums}
        before, prior, weights = weights, [], []
        for kind in range(len(KINDS)):
            totals = [sum(got.get((kind, 0, v), (0.0, 0.0))[y] for v in VOTES) for y in (0, 1)]
            prior.append(math.log((totals[0] + STRENGTH) / (totals[1] + STRENGTH)))
            for j in range(len(LABELERS)):
                for at, v in enumerate(VOTES):
                    true, false = got.get((kind, j, v), (0.0, 0.0))
                    weights.append(math.log((true + STRENGTH * PRIOR[1][at]) / (totals[0] + STRENGTH))
                                   - math.log((false + STRENGTH * PRIOR[0][at]) / (totals[1] + STRENGTH)))
        if max(abs(a - b) for a, b in zip(before, weights)) < STEADY:
            break
    return prior, weights


def feature_odds(scored: DataFrame) -> DataFrame:
    """(kind, feature, row, odds): what a feature adds to the log odds, at most FEATURE_ROWS rows per feature and kind."""
    each = scored.select("kind", "p", F.posexplode(F.array(*[F.col(f) for f in FEATURES])).alias("feature", "row"))
    rates = scored.groupBy("kind").agg(((F.sum("p") + 1) / (F.count("*") + 2)).alias("rate"))
    sums = each.groupBy("kind", "feature", "row").agg(F.sum("p").alias("true"), F.sum(1 - F.col("p")).alias("false"))
    odds = F.log((F.col("true") + STRENGTH * F.col("rate")) / (F.col("false") + STRENGTH * (1 - F.col("rate")))) - F.log(
        F.col("rate") / (1 - F.col("rate")))
    limited = F.greatest(F.least(odds, F.lit(FEATURE_LIMIT)), F.lit(-FEATURE_LIMIT))
    return sums.join(F.broadcast(rates), "kind").select("kind", "feature", "row", limited.alias("odds"))


def scored_candidates(rows: DataFrame) -> DataFrame:
    """Candidates with `score`, the probability that the trained classifier gives them."""
    patterns = durable(rows.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")))
    odds = vote_odds(*reliabilities(patterns))
    known = rows.withColumn("odds", odds).withColumn("p", chance(F.col("odds")))
    learned = durable(feature_odds(known))
    for at, name in enumerate(FEATURES):
        table = learned.filter(F.col("feature") == at).select("kind", F.col("row").alias(name), F.col("odds").alias(f"odds_{name}"))
        known = known.join(F.broadcast(table), ["kind", name], "left")
    total = F.col("odds")
    for name in FEATURES:
        total = total + F.coalesce(f"odds_{name}", F.lit(0.0))
    return known.withColumn("score", chance(total))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _clear(spans: Column, of: Column) -> Column:
    """Spans that overlap none of `of`."""
    return F.filter(spans, lambda s: ~F.exists(of, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def find(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    found = durable(candidates(docs))
    rows = durable(labelled(found))
    span = F.struct("start", "kind", "end")
    added = scored_candidates(rows).filter((F.col("tier") == WIDE) & (F.col("by_rule") == 1) & (F.col("score") >= least))
    added = added.groupBy("rid").agg(F.array_sort(F.collect_list(span)).alias("more"))
    spans = "array<struct<start:int,kind:int,end:int>>"
    base = F.array_sort(F.transform(F.filter("found", lambda c: c["tier"] == BASE), lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
    met = found.select("rid", "doc_id", base.alias("base")).join(added, "rid", "left").withColumn(
        "more", F.coalesce("more", F.array().cast(spans)))
    met = met.withColumn("kept", F.col("base"))
    for at in range(len(KINDS)):
        met = met.withColumn("kept", F.concat("kept", _clear(_of_kind(F.col("more"), at), F.col("kept"))))
    counts = [F.size(_of_kind(F.col("base"), at)).cast("long").alias(f"n_{name}") for at, name in enumerate(KINDS)]
    return met.select(
        "doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort("kept")).alias("spans"), (F.size("kept") - F.size("base")).cast("long").alias("n_added"))
