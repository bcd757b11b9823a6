"""Personal data by bootstrapped contextual extraction, in SQL functions throughout.

1. Addresses, numbers and cards of known form are found in every text (the base spans), with
   the words that stand before each.
2. The one and two words before a value are its patterns. Patterns that precede at least SEEDS
   different base values are counted in all texts: those whose next word is such a value in at least SHARE
   of their places are contexts. Plain words that follow a pattern thus count against it.
3. Every word that follows a context, with or without digits, is a candidate unless a base span
   touches it. Contexts and values form a graph, whose seeds are the base values. In each round a
   pattern is as good as the mean of its distinct values, and a value is what its patterns
   with enough seeds make it (noisy or). Values of seeds stay at one.
4. Candidates that a confident pattern precedes, and whose own score is high, are reported
   as spans of the kind ``id``.

Spans are ``kind:start:end`` in code points, end exclusive. The texts are copied once with a row number. Words of all texts
only meet the patterns of step 2 (broadcast if they are small, else joined by shuffle) and are counted;
what enters the graph is bounded by the base values, since these are a share of what follows a
context. Sums combine before the shuffle, so a pattern or value with very many rows is no single
task's. Candidates and base spans of a text are sorted and swept, whatever their number.

Cases: null and empty texts have no spans; very long texts are scanned whole; repeated rows are
found again in each row, but count once as values; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_triples.llm.common import table, text_or_empty
from spark_triples.operators.skew import key_join
from spark_triples.session import stage

KINDS = ("email", "ip", "card", "phone")
# Each finds the leftmost matches of the plain form: a run is entered at its start only (or where
# the last match ended), and what cannot be given back is not tried again.
_FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_WORD = r"[^\x20\x09-\x0D]+"
#: Characters before a value in which its context is sought, in whole words.
BEFORE = 80
#: Matches of a text whose places are summed in one go.
BLOCK = 256
#: Rounds; distinct seeds a pattern needs; scores from which patterns and values count.
ROUNDS, SEEDS, PATTERN, VALUE = 3, 3, 0.8, 0.8
#: Of the places of a context, those that a base value follows, at least.
SHARE = 0.5
_FOUND = "array<struct<start:bigint,end:bigint,value:string,before:string>>"


def _placed(steps: Column) -> Column:
    """(at, found): the length of some gaps and matches, and the places of the matches in it."""
    return F.aggregate(
        steps,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_FOUND).alias("found")),
        lambda done, s: F.struct(
            (done["at"] + s["gap"] + s["size"]).alias("at"),
            F.concat(
                done["found"],
                F.array(
                    F.struct(
                        (done["at"] + s["gap"]).alias("start"),
                        (done["at"] + s["gap"] + s["size"]).alias("end"),
                        s["value"].alias("value"),
                        s["before"].alias("before"),
                    )
                ),
            ).alias("found"),
        ),
    )


def _whole_words(gap: Column) -> Column:
    """The last BEFORE characters of what precedes a value, without a word that begins earlier."""
    cut = F.regexp_replace(F.right(gap, F.lit(BEFORE + 1)), r"^[^\x20\x09-\x0D]+", "")
    return F.when(F.length(gap) > BEFORE, cut).otherwise(gap)


def _located(text: Column, form: str, matches: Column) -> Column:
    """The matches with their places and with the end of what precedes each."""
    gaps = F.slice(F.split(text, form, -1), 1, F.size(matches))
    steps = F.zip_with(
        matches,
        gaps,
        lambda m, g: F.struct(
            F.length(g).cast("bigint").alias("gap"),
            F.length(m).cast("bigint").alias("size"),
            m.alias("value"),
            _whole_words(g).alias("before"),
        ),
    )
    none = F.array().cast(_FOUND)
    # Places are summed within blocks and then over blocks, so that a text with very many
    # matches costs little more than its length.
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")),
        lambda k: F.slice(steps, k * BLOCK + 1, F.lit(BLOCK)),
    )
    inside = F.transform(blocks, _placed)
    shifted = F.aggregate(
        inside,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts")),
        lambda done, block: F.struct(
            (done["at"] + block["at"]).alias("at"),
            F.concat(done["starts"], F.array(done["at"])).alias("starts"),
        ),
        lambda done: done["starts"],
    )
    placed = F.flatten(
        F.zip_with(
            inside,
            shifted,
            lambda block, at: F.transform(
                block["found"],
                lambda m: F.struct(
                    (m["start"] + at).alias("start"),
                    (m["end"] + at).alias("end"),
                    m["value"].alias("value"),
                    m["before"].alias("before"),
                ),
            ),
        )
    )
    return F.when(F.size(matches) > 0, placed).otherwise(none)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.split(value, r"\.")
        small = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(
            "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
        )
        return F.forall(parts, small)
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _only_valid(kind: str) -> Column:
    return F.filter(kind, lambda m: _valid(kind, m["value"]))


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text`` not null) with an array of located matches per kind."""
    text = F.col("text")
    out = docs
    for kind, form in _FORMS.items():
        matches = F.regexp_extract_all(text, F.lit(form), F.lit(0))
        if kind in _NEEDS:
            matches = F.when(text.contains(_NEEDS[kind]), matches).otherwise(F.array().cast("array<string>"))
        out = out.withColumn(f"_{kind}", matches)
    out = out.withColumns({kind: _located(text, form, F.col(f"_{kind}")) for kind, form in _FORMS.items()})
    return out.withColumns({k: _only_valid(k) for k in KINDS}).select(*docs.columns, *KINDS)


def _plain(text: Column) -> Column:
    """Without case, figures as ``0``."""
    return F.translate(F.lower(text), "123456789", "0" * 9)


def patterns(before: Column) -> Column:
    """The one and two words at the end of a text, without case, figures as ``0``."""
    words = F.filter(F.split(_plain(before), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    one = F.element_at(words, -1)
    two = F.concat_ws(" ", F.slice(words, -2, 2))
    return F.when(F.size(words) > 1, F.array(one, two)).when(F.size(words) == 1, F.array(one)).otherwise(
        F.array().cast("array<string>")
    )


def seed_rows(found: DataFrame) -> DataFrame:
    """(pattern, value): every pattern of every base value, as hashes."""
    matches = F.concat(*[F.transform(k, lambda m: F.struct(m["value"], m["before"])) for k in KINDS])
    rows = found.select(F.explode(matches).alias("m"))
    rows = rows.select(F.explode(patterns(F.col("m.before"))).alias("pattern"), "m.value")
    return rows.select(F.xxhash64("pattern").alias("pattern"), F.xxhash64(F.lower("value")).alias("value"))


def followed(texts: DataFrame) -> DataFrame:
    """(row, pattern): the one and two words before every word of the texts, as hashes."""
    words = F.filter(F.split(_plain(F.col("text")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = texts.select("row", words.alias("words"))
    none = F.lit(None).cast("string")
    # beside every word the one before it; the last word precedes nothing
    pairs = F.arrays_zip(
        F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))).alias("one"),
        F.slice(F.concat(F.array(none), "words"), 1, F.greatest(F.size("words") - 1, F.lit(0))).alias("two"),
    )
    rows = texts.select("row", F.explode(pairs).alias("w")).select("row", "w.one", "w.two")
    two = F.when(F.col("two").isNotNull(), F.xxhash64(F.concat_ws(" ", "two", "one")))
    rows = rows.select("row", F.explode(F.array(F.xxhash64("one"), two)).alias("pattern"))
    return rows.filter(F.col("pattern").isNotNull())


def contexts(seeds: DataFrame, texts: DataFrame, least: int = SEEDS, share: float = SHARE) -> DataFrame:
    """(pattern): those that precede enough base values, in number and as a share of their places."""
    per_value = seeds.groupBy("pattern", "value").agg(F.count("*").alias("n"))
    seeded = per_value.groupBy("pattern").agg(F.count("*").alias("seeds"), F.sum("n").alias("n"))
    seeded = stage(seeded.filter(F.col("seeds") >= least), "pii-seeded")
    places = key_join(followed(texts).select("pattern"), seeded.select("pattern"), "pattern", "left_semi", staged=True)
    places = places.groupBy("pattern").agg(F.count("*").alias("places"))
    kept = seeded.join(places, "pattern", "left").filter(F.col("n") >= share * F.coalesce("places", "n"))
    return stage(kept.select("pattern"), "pii-contexts")


def candidates(texts: DataFrame, found: DataFrame, chosen: DataFrame) -> DataFrame:
    """(row, start, end, value, pattern): words that follow a context and that no base span
    touches. ``chosen`` is staged and distinct."""
    rows = key_join(followed(texts), chosen, "pattern", "left_semi", staged=True).select("row").distinct()
    rows = stage(rows, "pii-rows")
    some = key_join(texts, rows, "row", "left_semi", staged=True)
    some = some.withColumn("_words", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    # what precedes a word is the space to the word before, so the words are set side by side
    located = some.select("row", _located(F.col("text"), _WORD, F.col("_words")).alias("at"))
    located = located.withColumn("values", F.transform("at", lambda m: _plain(m["value"])))
    none = F.array(F.lit(None).cast("string"))
    beside = F.arrays_zip(
        "at",
        F.slice(F.concat(none, "values"), 1, F.size("values")).alias("one"),
        F.slice(F.concat(none, none, "values"), 1, F.size("values")).alias("two"),
    )
    words = located.select("row", F.explode(beside).alias("w")).select("row", "w.at.*", "w.one", "w.two")
    words = words.filter(F.col("one").isNotNull())
    two = F.when(F.col("two").isNotNull(), F.xxhash64(F.concat_ws(" ", "two", "one")))
    words = words.select(
        "row",
        "start",
        "end",
        F.xxhash64(F.lower("value")).alias("value"),
        F.explode(F.array(F.xxhash64("one"), two)).alias("pattern"),
    ).filter(F.col("pattern").isNotNull())
    words = key_join(words, chosen, "pattern", "left_semi", staged=True)
    base = F.concat(*[F.transform(k, lambda m: F.struct(m["start"], m["end"])) for k in KINDS])
    base = key_join(found, rows, "row", "left_semi", staged=True).select("row", F.inline(base))
    return free(words, base)


def free(words: DataFrame, base: DataFrame) -> DataFrame:
    """The rows of ``words`` that no base span of their text touches: both are sorted and swept."""
    base = base.select("row", F.col("start").alias("start"), F.col("end").alias("end"), F.lit(True).alias("base"))
    line = words.unionByName(base, allowMissingColumns=True)
    sweep = lambda *order: Window.partitionBy("row").orderBy(*order).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(sweep("start"))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(sweep(F.col("start").desc()))
    line = line.withColumns({"reached": reached, "ahead": ahead}).filter(F.col("base").isNull())
    touched = (F.col("reached") > F.col("start")) | (F.col("ahead") < F.col("end"))
    return line.filter(~F.coalesce(touched, F.lit(False))).select(*words.columns)


def graph(seeds: DataFrame, words: DataFrame, chosen: DataFrame) -> DataFrame:
    """(pattern, value, seed): the distinct edges of contexts, as hashes."""
    seeds = key_join(seeds, chosen, "pattern", "left_semi", staged=True).withColumn("seed", F.lit(True))
    rows = seeds.unionByName(words.select("pattern", "value", F.lit(False).alias("seed")))
    return rows.groupBy("pattern", "value").agg(F.max("seed").alias("seed"))


def scores(edges: DataFrame, rounds: int = ROUNDS, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence, seeds) and (value, score) after some rounds over the graph."""
    edges = stage(edges, "pii-graph")
    values = edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    known = edges.groupBy("value").agg(F.max("seed").alias("known"))
    made = None
    for _ in range(rounds):
        made = edges.join(values, "value").groupBy("pattern").agg(
            F.avg("score").alias("confidence"), F.sum((F.col("score") >= VALUE).cast("long")).alias("seeds")
        )
        made = stage(made, "pii-patterns")
        good = made.filter(F.col("seeds") >= seeds)
        doubt = F.sum(F.log1p(-F.least("confidence", F.lit(0.999))))
        lifted = edges.join(good, "pattern").groupBy("value").agg((1 - F.exp(doubt)).alias("lifted"))
        values = known.join(lifted, "value", "left").select(
            "value", F.when(F.col("known"), 1.0).otherwise(F.coalesce("lifted", F.lit(0.0))).alias("score")
        )
        values = stage(values, "pii-values")
    return made, values


def discovered(words: DataFrame, made: DataFrame, values: DataFrame, seeds: int = SEEDS) -> DataFrame:
    """(row, new): the candidates that confident patterns precede, sorted."""
    strong = made.filter((F.col("confidence") >= PATTERN) & (F.col("seeds") >= seeds)).select("pattern")
    likely = values.filter(F.col("score") >= VALUE).select("value")
    hits = words.join(strong, "pattern", "left_semi").join(likely, "value", "left_semi")
    return hits.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("new")
    )


def _written(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")),
    )


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, n_<kind> …, base_sha256, spans, n_id) of every document."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts = stage(source.withColumn("row", F.monotonically_increasing_id()), "pii-texts")
    found = stage(base_spans(texts).drop("text"), "pii-found")
    texts = texts.select("row", "text")
    seeds = seed_rows(found)
    chosen = contexts(seeds, texts)
    words = stage(candidates(texts, found, chosen), "pii-candidates")
    made, values = scores(graph(seeds, words, chosen))
    new = discovered(words, made, values)
    base = F.concat(*[_written(k, F.col(k)) for k in KINDS])
    joined = found.join(new, "row", "left").withColumn(
        "new", F.coalesce("new", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    )
    return joined.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _written("id", F.col("new"))), ",").alias("spans"),
        F.size("new").cast("long").alias("n_id"),
    )


def op1_contextual_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return extract(table(spark, sf_dir, "documents"))
