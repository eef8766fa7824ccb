"""Personal data by weak supervision (DataFrame operations only).

Base spans (e-mail, IP, card, phone) follow fixed patterns.  Wider patterns
propose further candidates (spelled-out e-mails, bracketed IPs, numbers written
otherwise).  On every span, base ones included, four labelers vote yes, no or
nothing: the shape (regex), lists of known domains and number prefixes
(gazetteer), the words before it, and the characters around it (context).
Expectation-maximisation over the vote patterns estimates each labeler's
reliability by kind and, for each pattern, how likely it is personal data.
These likelihoods train the final classifier, naive Bayes over span features;
it accepts candidates, which are added where they overlap no base span and no
better candidate.  Base spans always stay.

Positions are code points: the text is split at the matches, and running sums
of the lengths of gaps and matches are window sums within a document, so a
text with any number of matches takes linear time.  The patterns are written
without repeated groups (a single separator or dot inside a run is first
replaced by a private character), so long runs neither recurse nor backtrack.

What the driver sees: counts of vote patterns (at most 81 a kind) and of
feature values (a fixed set); no row grows with the data.

Cases: a null text counts as empty; documents without spans are kept with
counts of 0; rows repeating id and text get the same spans; an empty table
gives an empty result; without candidates nothing is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import staged, table, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Private character that stands for a dot or separator inside a run.
_IN = "\ue000"
#: What stands for that character where a text has it itself.
_OWN = "\ue001"
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: Base patterns; for e-mail and card over text with inner dots or separators marked.
BASE = {
    "email": rf"(?:\G|(?<![{_IN}{_LOCAL}]))[{_IN}{_LOCAL}]++@[{_LABEL}]++{_IN}[{_IN}{_LABEL}]*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"(?<![0-9{_IN}])[0-9][0-9{_IN}]{{15,37}}+(?![0-9{_IN}])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_DOT = r"(?:\[\.\]|\(\.\)| \. )"
#: Patterns of further candidates.
WIDE = {
    "email": rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]{{1,64}} ?[\[(]at[\])] ?[A-Z0-9-]{{1,63}}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Z0-9-]{{1,63}}){{1,4}}",
    "ip": rf"(?<![A-Za-z0-9])[0-9]{{1,3}}{_DOT}[0-9]{{1,3}}{_DOT}[0-9]{{1,3}}{_DOT}[0-9]{{1,3}}(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9][0-9 .-]{11,36}[0-9](?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9+])[0-9(][0-9 ().-]{6,24}[0-9](?![A-Za-z0-9])",
}
#: A cheap test that a text can hold such a span at all.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
WIDE_HINT = {"email": r"(?i)[\[(]at[\])]", "ip": r"[0-9](?:\[\.|\(\.| \.)", "card": "[0-9][0-9 .-]{11}", "phone": "[0-9(][0-9 ().-]{6}"}
#: Gazetteers (fixed values): last labels of domains, first digits of card and phone numbers.
DOMAINS = ["com", "org", "net", "edu", "gov", "int", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "be", "us", "ca"]
CARD_PREFIX = "^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|65|62)"
PHONE_PREFIX = "^(?:0|1[2-9]|33|34|39|41|43|44|49|[2-9][0-9]{2}[2-9])"
#: Words before a span that speak for its kind, and words that speak against any.
FOR = {"email": r"mail|contact|kontakt|correo|courriel|write|reach", "ip": r"\bip\b|host|server|addr|ping|login",
       "card": r"card|visa|credit|karte|carte|tarjeta|pay|iban|account", "phone": r"tel|phone|call|fax|mobil|cell|whatsapp|ruf"}
AGAINST = r"version|licen|isbn|page|chapter|token|password|secret|order|year|\bno\b|nr|build|rev|hash|key|="
BEFORE, BLOCK, ROUNDS = 24, 256, 60


def _marked(text: Column, kind: str) -> Column:
    """The text, as long as before, with inner dots (e-mail) or separators (card) replaced."""
    inner = {"email": rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", "card": r"(?<=[0-9])[ -](?=[0-9])"}.get(kind)
    return text if inner is None else F.regexp_replace(F.translate(text, _IN, _OWN), inner, _IN)


def _hits(text: Column, source: str, kind: str) -> Column:
    """Matches of one pattern in a text: gaps before each, the matches, what stands around them; null without any."""
    base = source == "base"
    pattern, hint = (BASE, HINT) if base else (WIDE, WIDE_HINT)
    marked = _marked(text, kind) if base else text
    found = F.regexp_extract_all(marked, F.lit(pattern[kind]), F.lit(0))
    gaps = F.split(marked, pattern[kind], -1)
    row = F.struct(F.lit(source).alias("source"), F.lit(kind).alias("kind"), F.transform(gaps, F.length).alias("gaps"), found.alias("hits"),
                   F.transform(gaps, lambda g: F.right(g, F.lit(BEFORE))).alias("before"),
                   F.transform(gaps, lambda g: F.left(g, F.lit(1))).alias("after"))
    return F.when(text.rlike(hint[kind]), row)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits."""
    def part(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    values = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), part)
    return (F.length(digits) > 0) & (F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0)


def _valid() -> Column:
    """Whether a base match meets its kind's condition."""
    n = F.length("digits")
    small = F.forall(F.split("hit", r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (F.when(F.col("kind") == "email", True).when(F.col("kind") == "ip", small)
            .when(F.col("kind") == "card", F.when(n.between(16, 19), passes_luhn(F.col("digits"))).otherwise(False))
            .otherwise(n.between(8, 15)))


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, mark) of all rows, mark being a hash of the text; and the spans found:
    id, mark, source (base, wide), kind, start, end, hit, digits, before, after."""
    text = text_or_empty(text_col)
    matches = F.filter(F.array(*[_hits(text, s, k) for s in ("base", "wide") for k in KINDS]), lambda m: F.size(m.hits) > 0)
    rows = staged(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), matches.alias("matches")), "pii")
    some = rows.where(F.size("matches") > 0).dropDuplicates(["id", "mark"]).select("id", "mark", F.explode("matches").alias("m"))
    each = some.select("id", "mark", "m.source", "m.kind", F.posexplode(F.arrays_zip(
        F.slice("m.gaps", 1, F.size("m.hits")).alias("gap"), F.col("m.hits").alias("hit"),
        F.slice("m.before", 1, F.size("m.hits")).alias("before"), F.slice("m.after", 2, F.size("m.hits")).alias("after"))))
    upto = F.sum(F.col("col.gap") + F.length("col.hit")).over(Window.partitionBy("id", "mark", "source", "kind").orderBy("pos"))
    each = each.withColumn("end", upto).select(
        "id", "mark", "source", "kind", (F.col("end") - F.length("col.hit")).alias("start"), "end",
        F.translate("col.hit", _IN, ".").alias("hit"), "col.before", "col.after").withColumn("digits", _digits(F.col("hit")))
    n = F.length("digits")
    # a number that fails the check digit is no card, however it is written
    kept = (F.when(F.col("source") == "base", _valid())
            .when(F.col("kind") == "card", F.when(n.between(13, 19), passes_luhn(F.col("digits"))).otherwise(False))
            .when(F.col("kind") == "phone", n.between(7, 15)).otherwise(True))
    return rows.select("id", "mark"), staged(each.where(kept), "spans")


LABELERS = ("shape", "list", "words", "around")


def with_votes(spans: DataFrame) -> DataFrame:
    """The labelers' votes (1, -1, 0 for none) and the features of the final classifier."""
    kind, digits, n = F.col("kind"), F.col("digits"), F.length("digits")
    grouped = F.col("hit").rlike(r"^\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}$")
    shape = (F.when(kind == "card", F.when(passes_luhn(digits), 1).otherwise(-1))
             .when(kind == "phone", F.when(F.col("hit").startswith("+") | grouped, 1).when(F.col("hit").rlike(r"^[0-9.]+$"), -1).otherwise(0))
             .when(kind == "ip", F.when(n.between(4, 12), 1).otherwise(-1)).otherwise(1))
    last = F.lower(F.regexp_extract("hit", r"([A-Za-z0-9-]+)$", 1))
    listed = (F.when(kind == "email", F.when(last.isin(DOMAINS), 1).otherwise(-1))
              .when(kind == "card", F.when(digits.rlike(CARD_PREFIX), 1).otherwise(-1))
              .when(kind == "phone", F.when(digits.rlike(PHONE_PREFIX), 1).otherwise(-1)).otherwise(0))
    before = F.lower("before")
    for_kind = F.lit(False)
    for k in KINDS:
        for_kind = for_kind | ((kind == k) & before.rlike(FOR[k]))
    words = F.when(for_kind, 1).when(before.rlike(AGAINST), -1).otherwise(0)
    left = F.right("before", F.lit(1))
    open_left, open_right = ~left.rlike(r"[\p{L}\p{N}_]"), ~F.col("after").rlike(r"[\p{L}\p{N}_]")
    around = F.when(open_left & open_right, 1).otherwise(-1)
    spans = spans.withColumns(dict(zip(LABELERS, (shape, listed, words, around))))
    return spans.withColumns({
        "votes": F.concat_ws(",", *[F.col(v).cast("string") for v in LABELERS]),
        "f_digits": F.least(n, F.lit(20)).cast("string"),
        "f_marks": F.concat(*[F.when(F.col("hit").contains(c), c).otherwise("_") for c in " .-(+@["]),
        "f_words": F.col("words").cast("string"), "f_around": F.concat(open_left.cast("string"), open_right.cast("string")),
        "f_source": F.col("source"),
    })


FEATURES = ("f_digits", "f_marks", "f_words", "f_around", "f_source")


def reliabilities(patterns: list[tuple[str, str, int]], rounds: int = ROUNDS) -> dict[tuple[str, str], float]:
    """Expectation-maximisation over (kind, votes, count): how likely each pattern is a true span.

    For each kind a share of true spans and, per labeler, the odds of each vote
    for true and for false ones, all with one pseudo-count; starts from the
    mean vote."""
    out: dict[tuple[str, str], float] = {}
    for kind in KINDS:
        rows = [(votes, [int(v) for v in votes.split(",")], n) for k, votes, n in patterns if k == kind]
        true = {votes: 1 / (1 + math.exp(-2 * sum(vs) / 2)) for votes, vs, _ in rows}
        for _ in range(rounds):
            weight = {True: 1.0, False: 1.0}
            seen = {(t, j, v): 1.0 for t in (True, False) for j in range(len(LABELERS)) for v in (-1, 0, 1)}
            # a labeler is taken to be right more often than wrong
            for j in range(len(LABELERS)):
                seen[True, j, 1] += 1
                seen[False, j, -1] += 1
            for votes, vs, n in rows:
                for t, p in ((True, true[votes]), (False, 1 - true[votes])):
                    weight[t] += p * n
                    for j, v in enumerate(vs):
                        seen[t, j, v] += p * n
            for votes, vs, _ in rows:
                log = math.log(weight[True] / weight[False])
                for j, v in enumerate(vs):
                    log += math.log(seen[True, j, v] / sum(seen[True, j, x] for x in (-1, 0, 1)))
                    log -= math.log(seen[False, j, v] / sum(seen[False, j, x] for x in (-1, 0, 1)))
                true[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
        out |= {(kind, votes): p for votes, p in true.items()}
    return out


def _lookup(values: dict[str, float], key: Column, missing: float) -> Column:
    if not values:
        return F.lit(missing)
    table = F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(missing))


def with_scores(spans: DataFrame) -> DataFrame:
    """``spans`` with votes and score, the final classifier's log odds."""
    voted = staged(with_votes(spans), "votes")
    counts = voted.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()      # at most 81 a kind
    likely = reliabilities(sorted((r["kind"], r["votes"], r["n"]) for r in counts))
    post = _lookup({f"{k}|{v}": p for (k, v), p in likely.items()}, F.concat_ws("|", "kind", "votes"), 0.5)
    soft = voted.withColumn("true", F.round(post * 1_000_000).cast("long"))
    each = soft.select("kind", "true", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in ("kind", *FEATURES)])).alias("x"))
    sums = each.groupBy("kind", "x.f", "x.v").agg(F.sum("true").alias("true"), F.sum(1_000_000 - F.col("true")).alias("false")).collect()
    sums = {(r["kind"], r["f"], r["v"]): (r["true"] / 1e6, r["false"] / 1e6) for r in sums}
    of_kind = {k: sums.get((k, "kind", k), (0.0, 0.0)) for k in KINDS}
    score = _lookup({k: math.log((t + 1) / (f + 1)) for k, (t, f) in of_kind.items()}, F.col("kind"), 0.0)
    for feature in FEATURES:
        odds = {f"{k}|{v}": math.log((t + 0.5) / (of_kind[k][0] + 1)) - math.log((f + 0.5) / (of_kind[k][1] + 1))
                for (k, name, v), (t, f) in sums.items() if name == feature}
        score = score + _lookup(odds, F.concat_ws("|", "kind", feature), 0.0)
    return voted.withColumn("score", F.round(score, 9))


def _blocks(spans: DataFrame) -> DataFrame:
    """A row for each block of BLOCK characters that a span touches: overlapping spans share one."""
    return spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))))


def added_spans(scored: DataFrame) -> DataFrame:
    """Accepted candidates that overlap no base span and no better candidate: id, mark, kind, start, end."""
    base = _blocks(scored.where("source = 'base'")).select("id", "mark", "block", F.col("start").alias("s"), F.col("end").alias("e"))
    wide = scored.where("source = 'wide' and score > 0").select("id", "mark", "kind", "start", "end", "score")
    key = ["id", "mark", "kind", "start", "end"]

    def without(rows: DataFrame, others: DataFrame, better: Column) -> DataFrame:
        r, o = _blocks(rows).alias("r"), others.alias("o")
        same = F.col("r.id").eqNullSafe(F.col("o.id")) & (F.col("r.mark") == F.col("o.mark")) & (F.col("r.block") == F.col("o.block"))
        lost = r.join(o, same & (F.col("r.start") < F.col("o.e")) & (F.col("o.s") < F.col("r.end")) & better, "left_semi").select(*key).distinct()
        hit = rows["id"].eqNullSafe(lost["id"])
        for c in key[1:]:
            hit = hit & (rows[c] == lost[c])
        return rows.join(lost, hit, "left_anti")

    wide = without(wide, base, F.lit(True))
    rivals = _blocks(wide).select("id", "mark", "block", F.col("start").alias("s"), F.col("end").alias("e"), F.col("kind").alias("k"), F.col("score").alias("sc"))
    rank, other = F.struct("r.score", "r.end", "r.start", "r.kind"), F.struct("o.sc", "o.e", "o.s", "o.k")
    return without(wide, rivals, other > rank).select(*key)


def _listed(spans: Column) -> Column:
    """Spans as text, by kind as listed, then by start."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s.no), s.start.cast("string"), s.end.cast("string"))))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base and added spans as arrays of (no, start, end), no being the kind's place in KINDS."""
    rows, spans = found_spans(docs, id_col, text_col)
    scored = staged(with_scores(spans), "scored")
    no = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int").alias("no")
    span = F.struct(no, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    base = scored.where("source = 'base'").select("id", "mark", span.alias("span"), F.lit(True).alias("base"))
    added = added_spans(scored).select("id", "mark", span.alias("span"), F.lit(False).alias("base"))
    per = base.unionByName(added).groupBy("id", "mark").agg(
        F.collect_list(F.when(F.col("base"), F.col("span"))).alias("base"), F.collect_list(F.when(~F.col("base"), F.col("span"))).alias("added"))
    none = F.array().cast("array<struct<no:int,start:bigint,end:bigint>>")
    hit = rows["id"].eqNullSafe(per["id"]) & (rows["mark"] == per["mark"])
    return rows.join(per, hit, "left").select(rows["id"].alias(id_col), F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"))


def op8_pii(spark, sf_dir):
    found = personal_data(table(spark, sf_dir, "documents"))

    def count(no: int) -> Column:
        return F.size(F.filter("base", lambda s: s.no == no)).cast("long")

    counts = [count(no).alias(f"n_{kind}") for no, kind in enumerate(KINDS, 1)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.concat("base", "added")).alias("spans"))
