"""I-Match fingerprints from built-in functions.

Terms within a band of inverse document frequency form the lexicon. Its size is bounded: a term of
the lexicon is in at least a fixed share of the documents, so there are at most (mean distinct
terms per document) / share of them, whatever the number of documents; it is broadcast. Every one
of PARTS random subsets of the lexicon keeps a term with one of several probabilities, by a keyed hash; a document's fingerprint holds, for every subset, the hash of its sorted
distinct terms in it. Likeness of two fingerprints is the share of equal parts among those that are
not empty on both sides.

Defined results: null text is empty; a text without lexicon terms is fingerprinted by its sorted
terms, one without terms by itself, and is like an equal fingerprint only; the next document is the
one with the next id, repeated ids are ordered by text; a single document is its own next one.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlens.llm.frames import ascii_lower, shuffle_width, table, texts, words

PARTS = 48
#: A subset keeps a term with a probability of one in 32, 64 and so on to 1024, in turn; few terms
#: in a part let it survive an edit.
RARITIES = tuple(1 << (5 + i) for i in range(6))
#: Natural log of (documents / documents with the term).
IDF_BAND = (1.5, 7.5)
#: Documents that share a shuffle key; the keys follow ascending ids.
SEGMENTS = 256
ROWS_PER_BUCKET = 2_000
MAX_BUCKETS_PER_SEGMENT = 64
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def terms(text: Column) -> Column:
    """Distinct words, lower-cased A to Z, ASCII punctuation counted as blanks."""
    return F.array_distinct(words(F.translate(ascii_lower(text), _PUNCTUATION, " " * len(_PUNCTUATION))))


def lexicon(docs: DataFrame, n_docs: int, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """(term, part): the terms within the band, once for each subset that keeps them; the empty
    term, in part -1, stands for every document."""
    spark = docs.sparkSession
    df = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(F.lit(float(max(n_docs, 1))) / F.col("df"))
    parts = spark.range(PARTS).select(
        F.col("id").cast("int").alias("part"),
        F.get(F.array(*map(F.lit, RARITIES)), (F.col("id") % len(RARITIES)).cast("int")).alias("rarity"),
    )
    inside = df.filter((F.col("df") > 1) & idf.between(*band)).select("term")
    kept = inside.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).join(F.broadcast(parts), "part")
    kept = kept.filter(F.pmod(F.xxhash64("term", "part"), F.col("rarity")) == 0).select("term", "part")
    every = spark.range(1).select(F.lit("").alias("term"), F.lit(-1).alias("part"))
    return kept.unionByName(every)


def with_buckets(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``docs`` with buckets that follow the ids, the first document of every bucket again in the
    bucket before it (the last bucket gets the very first), and the number of documents.

    Segments come from quantiles of the ids and are cut evenly inside, so ids may be spaced
    unevenly. The bucket list has at most SEGMENTS * MAX_BUCKETS_PER_SEGMENT rows.
    """
    spark = docs.sparkSession
    shares = [i / SEGMENTS for i in range(1, SEGMENTS)]
    s = docs.agg(
        F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        F.percentile_approx("doc_id", shares, 10_000).alias("cuts"),
    ).first()
    if not s["n"] or s["lo"] is None:
        bucketed = docs.withColumn("bucket", F.lit(0).cast("long"))
        return bucketed, bucketed.withColumn("guest", F.lit(1)).limit(0), s["n"]
    starts = sorted({s["lo"], *s["cuts"]})
    ends = [*starts[1:], s["hi"] + 1]
    per = min(MAX_BUCKETS_PER_SEGMENT, max(4, -(-s["n"] // (len(starts) * ROWS_PER_BUCKET))))
    known = F.coalesce(F.col("doc_id"), F.lit(s["lo"]))
    at = F.size(F.filter(F.array(*map(F.lit, starts)), lambda c: c <= known))
    start, end = (F.element_at(F.array(*map(F.lit, x)), at) for x in (starts, ends))
    inside = F.floor((known - start).cast("double") * per / (end - start).cast("double"))
    bucketed = docs.withColumn("bucket", (at * per + F.least(inside, F.lit(per - 1))).cast("long"))
    firsts = bucketed.groupBy("bucket").agg(
        F.min("doc_id").alias("first_id"), F.max(F.col("doc_id").isNull()).alias("nulls")
    ).orderBy("bucket").collect()
    ids = [None if r["nulls"] else r["first_id"] for r in firsts]
    before = [(firsts[i - 1]["bucket"], x) for i, x in enumerate(ids)]
    wanted = spark.createDataFrame(before, "to_bucket long, first_id long")
    guests = docs.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("first_id")))
    guests = guests.select(*docs.columns, F.col("to_bucket").alias("bucket"), F.lit(1).alias("guest"))
    return bucketed, guests, s["n"]


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the share of equal parts among the parts that either has."""
    one, other = F.split(a, ","), F.split(b, ",")
    names = lambda x: F.transform(x, lambda part: F.substring(part, 1, 2))
    either = F.size(F.array_union(names(one), names(other)))
    return F.when(a == b, 1.0).otherwise(F.size(F.array_intersect(one, other)) / either)


def fingerprints(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Fingerprints of each of (doc_id, text), of its edited text, and their likeness."""
    spark = docs.sparkSession
    bucketed, guests, n = with_buckets(docs)
    parts = 2 * shuffle_width(spark)
    rows = bucketed.withColumn("guest", F.lit(0)).unionByName(guests).repartition(parts, "bucket")
    order = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    text, n_chars = F.col("text"), F.length("text")
    quarter = F.floor(n_chars / 4).cast("int")
    edited = F.concat(
        F.substring(text, F.lit(1), n_chars - quarter),
        F.substring(F.coalesce("next_text", "text"), F.lit(1), quarter),
    )
    placed = rows.withColumns(
        {"place": F.row_number().over(order), "next_text": F.lead("text").over(order)}
    ).withColumn("edited", edited)
    plain = lambda t, own: F.when(
        F.size(own) > 0, F.sha1(F.array_join(F.sort_array(own), " ").cast("binary"))
    ).otherwise(F.sha2(t.cast("binary"), 224))
    own = placed.select(
        "bucket", "place", "guest", "doc_id", n_chars.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "text", "edited",
        terms(text).alias("a"), terms(F.col("edited")).alias("b"),
    ).withColumns(
        {"plain": plain(text, F.col("a")), "edited_plain": plain(F.col("edited"), F.col("b"))}
    )
    info = F.struct("doc_id", "n_chars", "edited_sha256", "plain", "edited_plain")
    tagged = F.flatten(
        F.array(
            F.array(F.struct(F.lit(0).alias("side"), F.lit("").alias("term"), info.alias("info"))),
            F.transform("a", lambda x: F.struct(F.lit(0).alias("side"), x.alias("term"), F.lit(None).alias("info"))),
            F.transform("b", lambda x: F.struct(F.lit(1).alias("side"), x.alias("term"), F.lit(None).alias("info"))),
        )
    )
    keys = ["bucket", "place", "guest"]
    hits = own.select(*keys, F.explode(tagged).alias("x")).select(*keys, "x.side", "x.term", "x.info")
    hits = hits.join(F.broadcast(lexicon(docs, n, band)), "term")
    hashed = F.substring(F.sha1(F.array_join(F.sort_array(F.collect_list("term")), " ").cast("binary")), 1, 8)
    parts_of = hits.groupBy(*keys, "side", "part").agg(
        hashed.alias("hash"), F.first("info", ignorenulls=True).alias("info")
    ).withColumn("entry", F.concat(F.lpad(F.col("part").cast("string"), 2, "0"), F.lit(":"), F.col("hash")))
    of = lambda side: F.array_join(
        F.sort_array(F.collect_list(F.when((F.col("side") == side) & (F.col("part") >= 0), F.col("entry")))), ","
    )
    found = parts_of.groupBy(*keys).agg(
        of(0).alias("a"), of(1).alias("b"), F.first("info", ignorenulls=True).alias("info")
    )
    both = found.select(
        *keys, "info.doc_id", "info.n_chars", "info.edited_sha256",
        F.when(F.col("a") != "", F.col("a")).otherwise(F.col("info.plain")).alias("fingerprint"),
        F.when(F.col("b") != "", F.col("b")).otherwise(F.col("info.edited_plain")).alias("edited_fingerprint"),
    )
    following = Window.partitionBy("bucket").orderBy("place")
    return (
        both.withColumn("next_fingerprint", F.lead("fingerprint").over(following))
        .filter(F.col("guest") == 0)
        .select(
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.coalesce("next_fingerprint", "fingerprint")).alias("near_next"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(texts(table(spark, sf_dir, "documents")))
