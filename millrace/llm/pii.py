"""PII (operator 7): base patterns and bootstrapped contextual extraction, in DataFrame functions only.

Base entities are found by kind (email, ip, card, phone): leftmost matches that
do not overlap within a kind, checked (parts, Luhn, digit counts), with code
point positions.  The patterns are written so that they give the matches of the
plain ones without trying a long run from each of its characters.

The base entities are seeds.  The words around an occurrence (left word, right
word, both) are lexical patterns; punctuation that stands alone there, and the
start and end of a text, count as words; other identifier-like tokens (letters, digits
and inner punctuation, with at least two digits) are candidate instances.
Patterns and instances form a bipartite graph with counts.  Scores run over it
for ``ROUNDS`` rounds: a pattern's confidence is the mean score of its
instances, an instance's score the mean confidence of its patterns (seeds stay
at 1).  Patterns with ``SUPPORT`` distinct seeds and a confidence of
``CONFIDENT`` discover the candidates they stand around, as kind ``id``.
Discovered instances count as seeds for the support of further patterns (with
their own score), and it goes on until nothing new is discovered.

All text work is one pass; the graph holds only occurrences, and its sums are
aggregations by pattern or by instance with map-side combine.  Defined cases:
null text counts as empty; documents without findings have zero counts and
empty strings; every row is judged on its own, so equal rows give equal results;
null or repeated doc_ids are kept; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

KINDS = ["email", "ip", "card", "phone", "id"]
# \G: where the last match ended; a start inside a run fails like the run's own start
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# a start after letters and inner punctuation would fail like the one before them, so a long run is tried once
CANDIDATE = r"(?<![A-Za-z0-9])(?<![A-Za-z0-9][._/-]{1,8})(?=[A-Za-z._/-]*+[0-9])[A-Za-z0-9](?:[A-Za-z0-9._/@-]*[A-Za-z0-9])?"
CONTEXT = 48  # code points looked at on either side
START, END = "<start>", "<end>"  # outer punctuation: no word of a text is written so
ROUNDS, SUPPORT, CONFIDENT = 3, 5, 0.9
_SPAN = "array<struct<start:int,end:int,value:string>>"


def found(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their positions (code points, end exclusive)."""
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    piece = F.split(text, pattern, -1)

    def step(acc, x):
        start = acc["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        one = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    pairs = F.slice(F.arrays_zip(piece.alias("piece"), match.alias("match")), 1, F.size(match))
    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v: Column) -> Column:
    d = F.reverse(_digits(v))
    def worth(i):
        x = F.substring(d, i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, x * 2).otherwise(x)
        return F.when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def _in_range(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, value), by start, then kind."""
    none = F.array().cast(_SPAN)
    email = F.when(F.contains(text, F.lit("@")), found(text, EMAIL)).otherwise(none)
    ip = F.when(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), found(text, IP)).otherwise(none)
    card = F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), found(text, CARD)).otherwise(none)
    phone = F.when(F.contains(text, F.lit("+")), found(text, PHONE)).otherwise(none)
    length = lambda v: F.length(_digits(v))
    checked = [
        email,
        F.filter(ip, lambda x: F.forall(F.split(x["value"], r"\."), _in_range)),
        F.filter(card, lambda x: length(x["value"]).between(12, 19) & luhn(x["value"])),
        F.filter(phone, lambda x: length(x["value"]).between(9, 15)),
    ]

    def of_kind(k: int):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end"), x["value"].alias("value"))

    return F.array_sort(F.concat(*[F.transform(a, of_kind(k)) for k, a in enumerate(checked)]))


def _word(side: Column, last: bool) -> Column:
    """The word of a context next to the entity: lower case, digits as 0, outer punctuation off unless there is nothing else."""
    w = F.regexp_replace(F.lower(F.regexp_extract(side, r"(\S+)\s*$" if last else r"^\s*(\S+)", 1)), "[0-9]+", "0")
    inner = F.regexp_replace(w, r"^[^\p{L}\p{N}=:#]+|[^\p{L}\p{N}=:#]+$", "")
    return F.when(w == "", F.lit(START if last else END)).when(inner == "", w).otherwise(inner)


def _with_context(text: Column, spans: Column, seed: bool) -> Column:
    def one(x):
        left = F.substring(text, F.greatest(x["start"] + 1 - CONTEXT, F.lit(1)), F.least(x["start"], F.lit(CONTEXT)))
        right = F.substring(text, x["end"] + 1, F.lit(CONTEXT))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), F.lit(seed).alias("seed"),
                        _word(left, True).alias("left"), _word(right, False).alias("right"))
    return F.transform(spans, one)


def entities(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` (base spans) and ``_near`` (seeds and candidates with their context words)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("_base", base_spans(text))
    rows = rows.withColumn("_cand", F.when(text.rlike("[0-9]"), found(text, CANDIDATE)).otherwise(F.array().cast(_SPAN)))
    free = F.filter("_cand", lambda c: (F.length(c["value"]) >= 5) & (F.length(_digits(c["value"])) >= 2)
                    & ~F.exists("_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return rows.withColumn("_near", F.concat(_with_context(text, F.col("_base"), True), _with_context(text, free, False))).drop("_cand")


def discovered(near: DataFrame) -> DataFrame:
    """rid, start, end of the candidates that confident patterns discover; ``near``: rid and an occurrence a row."""
    kinds = F.array(*[F.struct(F.lit(t).alias("type"), w.alias("words")) for t, w in
                      (("l", F.col("left")), ("r", F.col("right")), ("lr", F.concat_ws(" _ ", "left", "right")))])
    words = near.select("rid", "start", "end", "value", "seed", F.explode(kinds).alias("p")) \
        .select("rid", "start", "end", "value", "seed", F.concat_ws(":", "p.type", "p.words").alias("pattern"))
    occurrences = stored(words, "pii-occurrences")
    every = stored(occurrences.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "pii-graph")
    known = stored(every.where("seed").select("value").distinct(), "pii-known")
    n_known, sure = known.count(), None
    while True:
        # only patterns with enough distinct seeds, given or discovered, can discover anything
        able = every.join(known, "value", "left_semi").groupBy("pattern").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= SUPPORT).select("pattern")
        edges = stored(every.join(able, "pattern"), "pii-edges")
        score = edges.select("value").distinct().join(known.withColumn("known", F.lit(1.0)), "value", "left") \
            .select("value", F.coalesce("known", F.lit(0.0)).alias("score"))
        for _ in range(ROUNDS):
            belief = edges.join(score, "value").groupBy("pattern").agg(F.avg("score").alias("belief"))
            belief = stored(belief, "pii-patterns")
            score = stored(edges.join(belief, "pattern").groupBy("value").agg(
                F.when(F.max("seed"), F.lit(1.0)).otherwise(F.avg("belief")).alias("score")), "pii-instances")
        fresh = belief.where(F.col("belief") >= CONFIDENT).select("pattern")
        sure = stored(fresh if sure is None else sure.union(fresh).distinct(), "pii-sure")  # what was found stays found
        known = stored(known.union(edges.join(sure, "pattern").select("value")).distinct(), "pii-known")
        before, n_known = n_known, known.count()
        if n_known == before:
            break
    return occurrences.where(~F.col("seed")).join(sure, "pattern").select("rid", "start", "end").distinct()


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` and ``_all`` (base and discovered spans, by start, then kind)."""
    kept = docs.drop("_rid", "_base", "_all", "_near", "_cand")
    rows = stored(entities(kept).withColumn("_rid", F.monotonically_increasing_id()), "pii")
    near = rows.select(F.col("_rid").alias("rid"), F.explode("_near").alias("x")).select("rid", "x.*")
    more = discovered(near).groupBy("rid").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("id")).alias("kind"), "end")).alias("_more"))
    base = F.transform("_base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    joined = rows.drop("_near").join(more, F.col("_rid") == F.col("rid"), "left")
    return joined.withColumn("_all", F.when(F.col("_more").isNull(), base).otherwise(F.array_sort(F.concat(base, "_more")))) \
        .drop("_more", "rid", "_rid")


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256, spans, n_discovered: one row a document."""
    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")) if "text" in docs.columns else docs
    count = lambda k: F.size(F.filter("_base", lambda x: x["kind"] == k)).cast("long")
    return rows.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
                       F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_all")).alias("spans"),
                       (F.size("_all") - F.size("_base")).cast("long").alias("n_discovered"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping spans by the first one's); ``n_chars`` follows."""
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def step(acc, x):
        fresh = x["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.get(name, x["kind"])))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate("_all", zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    # the row stands apart from the text, so no column of it can clash with the operator's own
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = with_spans(docs.select(whole, "text")).withColumn("some", F.size("_all") > 0).withColumn("text", F.when(F.col("some"), clean).otherwise(F.col("text")))
    out = []
    for c in docs.columns:
        old = F.col("doc").getField(c)
        if c == "text":
            out.append(F.col("text"))
        elif c == "n_chars":
            out.append(F.when(F.col("some"), F.length("text")).otherwise(old).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(old.alias(c))
    return rows.select(*out)
