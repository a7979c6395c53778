"""Personal data: candidate spans, boosted trees, calibrated threshold.

DataFrame functions and Spark's own boosted trees, no Python per row.

* Base generators find e-mail addresses, IP numbers, card numbers and phone
  numbers by pattern; a validator per kind (parts, Luhn, digit counts) decides,
  and what passes is always selected.
* Wide generators propose further, overlapping spans (spelled-out addresses,
  phone numbers without a country, grouped card numbers, long IP numbers).
  A validator per kind decides whether one reads as its kind at all (top-level
  domain, eight parts, Luhn, digit count and neither a date nor a dotted quad).
* Boosted trees score every candidate by format and context: its kind, its groups of
  digits, letters, digits and marks next to it, announcing words, and how often the
  words before and after it stand next to personal data. What the
  validators read (digit counts, check digits, ranges) decides labels only and is no
  feature. Learnt as personal: base spans that pass their validator, a phone number
  also without its country and its area, a card number also in four groups. Learnt as not
  personal: candidates that fail and overlap nothing that passes, a number for each
  kind whose count of digits it has. Wide proposals that pass are in neither class:
  they are what is asked for.
* Every distinct labelled candidate is learnt from. By a hash of content and context
  (so not by the partitioning) each has one part: two fifths give the words' odds,
  two fifths grow the trees, one fifth calibrates; the latter two hold each candidate
  also with its words unknown. Odds are in steps of 1 / ``FINE``, so that the trees and
  thresholds read each combination of features once, weighted by its number of
  candidates: that table does not grow with the input. The threshold of a
  kind keeps ``KEPT`` of the calibration's validated candidates (of all kinds, where
  it has none of this one). It is set on recall, as the validators have already
  rejected every look-alike of which the label is known. Wide proposals that pass
  their validator are added at or over it where nothing else covers them.

Patterns are written so that each scans a text once (no start inside a run that
has failed), which keeps very long texts linear; texts without a digit or an at
sign skip them.

Defined results: spans are code points, end exclusive, of the whole text; a null
or empty text has none; repeated rows each get their result; without both
classes among the labelled candidates (or without any) nothing is added. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, STEP = 12, 3, 0.3
#: Steps in one unit of a word's odds, and the largest odds.
FINE, MOST = 16, 8.0
#: Every value of a feature may become a split. Spark looks for splits in all rows up to
#: the square of it, which is more than there are combinations of features.
BINS = 8192
#: Share of the validated candidates of a kind that its threshold keeps.
KEPT = 0.98
#: Code points of context on each side.
CONTEXT = 24

_MAIL = r"[A-Za-z0-9._%+-]"
#: (generator, kind, pattern, what a text must contain). The first four are the base.
GENERATORS = (
    ("email", "email", rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", "ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "0"),
    ("card", "card", r"[0-9](?:[\x20-]?[0-9])++", "0"),
    ("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    ("email_spelled", "email", r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}\x20?[\[(]\x20?[Aa][Tt]\x20?[\])]\x20?[A-Za-z0-9-]{1,64}(?:(?:\.|\x20?[\[(]\x20?[Dd][Oo][Tt]\x20?[\])]\x20?)[A-Za-z0-9-]{1,64}){1,4}", "at"),
    ("ip_long", "ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", ":"),
    ("card_grouped", "card", r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{3,6}){2,3}(?![0-9])", "0"),
    ("phone_local", "phone", r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9A-Za-z])", "0"),
)
BASE = KINDS
#: Words that announce personal data.
CUES = "mail|e-mail|email|contact|phone|tel|telephone|call|fax|mobile|cell|ip|host|server|address|card|visa|credit|pay|account"

#: Groups of digits that are no phone number (dates, a range of years, a dotted quad).
_YEAR, _TWO = "(?:19|20)[0-9]{2}", "[0-9]{2}"
NO_PHONE = rf"^(?:{_YEAR}([.\x20-]){_TWO}\1{_TWO}|{_TWO}([.\x20-]){_TWO}\2{_YEAR}|{_YEAR}[\x20-]{_YEAR}|[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}})$"

FEATURES = ("address", "card", "phone", "groups", "cue", "mark_before", "digit_before", "digit_after", "letter_before", "letter_after", "odds_before", "odds_after")


def _has(text: Column, what: str) -> Column:
    if what == "0":
        return text.rlike("[0-9]")
    if what == "at":
        return text.rlike(r"(?i)[\[(]\x20?at\x20?[\])]")
    return text.contains(what)


def _matches(text: Column, pattern: str, what: str) -> Column:
    """Matches with the length of the gap before each and the context."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    before = F.slice(gaps, F.lit(1), F.size(hits))
    after = F.slice(gaps, F.lit(2), F.size(hits))
    found = F.transform(F.arrays_zip(before.alias("b"), hits.alias("h"), after.alias("a")), lambda x: F.struct(
        F.length(x["b"]).alias("gap"), x["h"].alias("hit"), F.right(x["b"], F.lit(CONTEXT)).alias("left"), F.left(x["a"], F.lit(CONTEXT)).alias("right")))
    return F.when(_has(text, what), found).otherwise(F.array().cast("array<struct<gap:int,hit:string,left:string,right:string>>"))


def numbered(docs: DataFrame) -> DataFrame:
    """row (a number), doc_id, text, written once so that every later use of the
    numbers means the same rows."""
    return materialize(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "numbered")


def proposals(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row (its number, given here unless it has one),
    doc_id, and the matches of every generator. One pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.array(*[F.struct(F.lit(g).alias("generator"), F.lit(k).alias("kind"), _matches(text, p, w).alias("found")) for g, k, p, w in GENERATORS])
    row = F.monotonically_increasing_id() if docs.columns != ["row", "doc_id", "text"] else F.col("row")
    return materialize(docs.select(row.alias("row"), "doc_id", F.filter(found, lambda g: F.size(g["found"]) > 0).alias("found")), "proposals")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of 13 to 19 digits has a valid check digit."""
    def add(total: Column, i: Column) -> Column:
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.when(n.between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def candidates(found: DataFrame) -> DataFrame:
    """One row per candidate: row, kind, generator, start, end, hit, context,
    base (a base generator's), valid (its validator's answer) and groups of digits
    (at most 6; 0 for addresses and IP numbers)."""
    each = (found.where("size(found) > 0").select("row", F.explode("found").alias("g"))
            .select("row", "g.generator", "g.kind", F.posexplode("g.found").alias("i", "m")))
    upto = Window.partitionBy("row", "generator").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.length("m.hit")).over(upto)
    flat = each.withColumn("end", end).select("row", "generator", "kind", (F.col("end") - F.length("m.hit")).alias("start"), "end", "m.hit", "m.left", "m.right")
    flat = flat.withColumn("digits", _digits(F.col("hit"))).withColumn("luhn", luhn(F.col("digits")))
    n = F.length("digits")
    part = r"0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    valid = (F.when(F.col("generator") == "email", F.lit(True))
             .when(F.col("generator") == "ip", F.col("hit").rlike(rf"^{part}(?:\.{part}){{3}}$"))
             .when(F.col("generator") == "card", F.col("luhn"))
             .when(F.col("generator") == "phone", n.between(9, 15))
             .when(F.col("generator") == "email_spelled", F.col("hit").rlike("[A-Za-z]{2}$"))
             .when(F.col("generator") == "ip_long", F.col("hit").rlike("^(?:[^:]+:){7}[^:]+$"))
             .when(F.col("generator") == "card_grouped", F.col("luhn"))
             # a country of one to three digits makes it a valid phone number
             .when(F.col("generator") == "phone_local", n.between(6, 14) & ~F.col("hit").rlike(NO_PHONE)).otherwise(F.lit(False)))
    groups = F.when(F.col("kind").isin("card", "phone"), F.least(F.size(F.regexp_extract_all("hit", F.lit("[0-9]+"), 0)), F.lit(6))).otherwise(F.lit(0))
    return flat.withColumn("base", F.col("generator").isin(*BASE)).withColumn("valid", valid).withColumn("groups", groups)


def _examples(cands: DataFrame) -> DataFrame:
    """Candidates with a label: 1 for validated base spans, 0 for those that fail
    their validator and overlap nothing that passes one. Equal ones once; ``part``
    (0 to 4) comes from their content and context."""
    row = Window.partitionBy("row").orderBy("start", "end", "generator")
    passed = lambda c: F.when(F.col("valid"), F.col(c))
    before = F.max(passed("end")).over(row.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(passed("start")).over(row.rowsBetween(1, Window.unboundedFollowing))
    covered = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    own = F.xxhash64("generator", "hit", "left", "right", F.lit(5))
    known = cands.withColumn("covered", covered).where("(base and valid) or not (valid or covered)")
    n, groups, kind = F.length("digits"), F.col("groups"), F.col("kind")
    form = lambda kind, groups: F.struct(kind.alias("kind"), groups.alias("groups"))
    country = F.col("hit").rlike(r"^\+[0-9]{1,3}[^0-9]")
    forms = (F.when(F.col("valid") & (kind == "phone") & country, F.array(*[form(kind, F.greatest(groups - k, F.lit(1))) for k in (0, 1, 2)]))
             .when(F.col("valid") & (kind == "card") & (groups == 1), F.array(form(kind, groups), form(kind, F.lit(4))))
             .when(F.col("valid") | (F.col("generator") != "card"), F.array(form(kind, groups)))
             .when(n.between(15, 19), F.array(form(kind, groups))).when(n.between(13, 14), F.array(form(kind, groups), form(F.lit("phone"), groups)))
             .when(n.between(6, 12), F.array(form(F.lit("phone"), groups))))
    known = known.select(F.posexplode(forms).alias("form", "as"), "left", "right", F.col("valid").cast("double").alias("label"), own.alias("o"))
    known = known.select("as.kind", "as.groups", "form", "left", "right", "label", "o").distinct()
    return known.withColumn("part", F.pmod("o", F.lit(5)))


def _context(rows: DataFrame) -> DataFrame:
    """``rows`` with the features of format and context but for the words' odds, and
    the words before and after."""
    left, right = F.lower("left"), F.lower("right")
    features = {
        "address": F.col("kind") == "email", "card": F.col("kind") == "card", "phone": F.col("kind") == "phone", "groups": F.col("groups"), "cue": left.rlike(rf"\b(?:{CUES})\b"), "mark_before": left.rlike(r"[:=#/_-]\s*$"),
        "digit_before": left.rlike(r"[0-9][.,:/-]?$"), "digit_after": right.rlike(r"^[.,:/-]?[0-9]"),
        "letter_before": left.rlike(r"\p{L}$"), "letter_after": right.rlike(r"^\p{L}"),
    }
    words = {"word_before": F.regexp_extract(left, r"(\p{L}+)[^\p{L}]*$", 1), "word_after": F.regexp_extract(right, r"^[^\p{L}]*(\p{L}+)", 1)}
    return rows.withColumns({k: c.cast("double") for k, c in features.items()} | words)


def _word_odds(examples: DataFrame) -> DataFrame:
    """(side, word, odds): the logarithm of how much oftener a word stands there
    next to personal data than next to other numbers, in steps of 1 / ``FINE``. As many
    rows as there are words: join it by the word, not by a broadcast."""
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"word_{s}").alias("word")) for s in ("before", "after")]))
    counts = examples.select(sides.alias("w"), "label").groupBy("w.side", "w.word").agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
    sums = counts.groupBy("side").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    odds = F.log((F.col("good") + 1) / (F.col("all_good") + 2)) - F.log((F.col("bad") + 1) / (F.col("all_bad") + 2))
    stepped = F.greatest(F.least(F.round(odds * FINE) / FINE, F.lit(MOST)), F.lit(-MOST))
    return counts.join(F.broadcast(sums), "side").select("side", "word", stepped.alias("odds"))


def _with_odds(rows: DataFrame, odds: DataFrame) -> DataFrame:
    """``rows`` with the odds of their words; 0 for a word without."""
    for side in ("before", "after"):
        known = odds.where(F.col("side") == side).select(F.col("word").alias(f"word_{side}"), F.col("odds").alias(f"odds_{side}"))
        rows = rows.join(known.hint("merge"), f"word_{side}", "left").withColumn(f"odds_{side}", F.coalesce(f"odds_{side}", F.lit(0.0)))
    return rows


def _weighted(examples: DataFrame) -> DataFrame:
    """Combinations of held (the part that calibrates), kind, label and features, each with
    its number of examples as ``weight``. Each example counts with its words' odds and
    with its words unknown."""
    words = {f: F.when(F.col("told"), F.col(f)).otherwise(F.lit(0.0)) for f in ("odds_before", "odds_after")}
    both = examples.withColumn("told", F.explode(F.array(F.lit(True), F.lit(False)))).withColumns(words)
    return both.groupBy((F.col("part") == 4).alias("held"), "kind", "label", *FEATURES).agg(F.count("*").alias("weight"))


def trained(cands: DataFrame) -> tuple[GBTClassificationModel, DataFrame, dict[str, float]] | None:
    """The trees, the words' odds and the calibrated threshold of every kind; None
    if there is nothing to learn from."""
    examples = materialize(_context(_examples(cands)).drop("left", "right"), "pii-examples")
    classes = {(r["part"], r["label"]) for r in examples.select("part", "label").distinct().collect()}  # at most ten rows
    has = lambda parts, label: any((p, label) in classes for p in parts)
    if not (has((2, 3), 0.0) and has((2, 3), 1.0) and has((4,), 1.0)):
        return None
    odds = materialize(_word_odds(examples.where("part < 2")), "pii-words")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        materialize(_weighted(_with_odds(examples.where("part >= 2"), odds)), "pii-vectors"))
    grown = vectors.where("not held").orderBy("label", *FEATURES).select("features", "label", "weight")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=5, maxBins=BINS, weightCol="weight").fit(grown)
    held = model.transform(vectors.where("held and label = 1")).select("kind", "weight", _score().alias("score"))
    floor = (F.floor(F.percentile("score", F.lit(1 - KEPT), F.col("weight")) * 100) / 100).alias("floor")
    known = {r["kind"]: r["floor"] for r in held.rollup("kind").agg(floor).collect()}  # at most five rows
    return model, odds, {k: known.get(k, known[None]) for k in KINDS}


def _score() -> Column:
    return vector_to_array("probability")[1]


def scored(cands: DataFrame) -> DataFrame:
    """Candidates with the trees' score and the calibrated threshold of their kind
    (2, which no score reaches, if there is nothing to learn from)."""
    learnt = trained(cands)
    if learnt is None:
        return cands.withColumns({"score": F.lit(0.0), "threshold": F.lit(2.0)})
    model, odds, floors = learnt
    threshold = F.element_at(F.create_map(*[F.lit(x) for pair in floors.items() for x in pair]), F.col("kind"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(_with_odds(_context(cands), odds))
    return model.transform(vectors).withColumns({"score": _score(), "threshold": threshold})


def spans(found: DataFrame) -> DataFrame:
    """Selected spans: row, kind, start, end, base, score. Base spans that pass
    their validator, and added ones that overlap nothing better."""
    cands = materialize(candidates(found), "candidates")
    table = scored(cands)
    base = F.col("base") & F.col("valid")
    chosen = table.where(base | (~F.col("base") & F.col("valid") & (F.col("score") >= F.col("threshold")))).select("row", "kind", "start", "end", base.alias("base"), "score")
    # runs of overlapping spans: an added span stays only as the best of a run without a base span
    earlier = Window.partitionBy("row").orderBy("start", "end", "kind", "base")
    fresh = F.coalesce(F.col("start") >= F.max("end").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = chosen.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(earlier.rowsBetween(Window.unboundedPreceding, 0)))
    of_run = Window.partitionBy("row", "run")
    best = F.row_number().over(of_run.orderBy(F.desc("base"), F.desc("score"), "start", "end", "kind"))
    runs = runs.withColumn("best", best).where("base or best = 1")
    return materialize(runs.select("row", "kind", "start", "end", "base", "score"), "spans")


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, spans (kind, start, end, base) by
    kind and start."""
    found = proposals(docs)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    per_row = spans(found).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "kind", "base"))).alias("spans"))
    return found.select("row", "doc_id").join(per_row, "row", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast("array<struct<rank:bigint,start:bigint,end:bigint,kind:string,base:boolean>>")))


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind> and base_sha256 of the base spans, and spans: all of them
    as kind:start:end, by kind and start."""
    told = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find(docs).select("doc_id", *map(count, KINDS), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every selected span replaced by its kind in brackets."""
    rows = numbered(docs)
    cuts = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substr("text", (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    whole = F.aggregate("cuts", start, step, lambda a: F.concat(a["out"], F.substr("text", (a["at"] + 1).cast("int"))))
    return (rows.join(find(rows).select("row", cuts.alias("cuts")), "row")
            .withColumn("text", F.coalesce("text", F.lit(""))).select("doc_id", whole.alias("text")))
