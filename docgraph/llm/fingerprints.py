"""Document fingerprints: SimHash of weighted terms, and a search within a Hamming radius by permuted block tables. DataFrame functions only.

The terms of a text are its distinct words ``[^\\x20\\x09-\\x0D]+``. A term weighs as many votes as it has characters, up to ``MOST_VOTES``: long words
are rarer, so they tell more about a text. The 128 bits of a term's hashes (xxhash64 with two seeds) vote for the bits of the fingerprint: for
a set bit the weight counts for, else against. A bit is set if the votes for it are at least half of all. Votes are added up four to a long, 16 bits each,
over ``CHUNK`` terms at most, so that no sum reaches the next; the sums of chunks are added up two to a long. Terms are grouped where their text is: no
term is shuffled if the texts are partitioned by one of their keys.

Search: a fingerprint is cut into ``radius + spare`` blocks. Two fingerprints within the radius differ in at most ``radius`` blocks, so they agree in
``spare`` others; for each choice of ``spare`` blocks there is a table keyed by these blocks, and what shares a key is compared in full. A pair is
taken from the first table that holds it only. Equal fingerprints are one entry. The comparison is part of the join, so only links leave it.

Edited texts (``edited_texts``): each document with the start of the next one in place of its own second half; the order of the ids is found on
the ids alone, and only the starts that are needed move to the document before.

Defined results: null texts count as empty; a text without words has the empty term alone. Texts of any length are treated whole (up to 2^30
votes fit). A null ``doc_id`` counts as the least number. Documents that share an id are documents of their own with the same next document,
and of several next documents the one with the greatest xxhash64 of its text counts. A single document is its own next one. Without rows
there is no result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.plans.scratch import write_table

# A fingerprint is an array of WORDS longs.
WORDS = 2
RADIUS = 3
SPARE = 1
MOST_VOTES = 16
CHUNK = ((1 << 15) - 1) // MOST_VOTES

_LEAST_ID = -(1 << 63)
_WORD_BREAK = r"[\x20\x09-\x0D]+"


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` (which tell the rows apart) and the fingerprint of ``text`` as an array of longs, ``simhash``."""
    words = F.array_distinct(F.filter(F.split(F.col(text), _WORD_BREAK, -1), lambda w: w != ""))
    each = texts.select(*keys, words.alias("_words"))
    # The outer form: the inner one would make Spark split every text once more, to leave out empty arrays beforehand.
    each = each.select(*keys, F.posexplode_outer("_words").alias("_at", "_term")).withColumn("_term", F.coalesce("_term", F.lit("")))
    weight = F.least(F.greatest(F.char_length("_term"), F.lit(1)), F.lit(MOST_VOTES)).cast("long").alias("_votes")
    chunk = F.coalesce(F.floor(F.col("_at") / CHUNK), F.lit(0)).cast("int").alias("_chunk")
    each = each.select(*keys, chunk, weight, *[F.xxhash64(F.lit(k), "_term").alias(f"_h{k}") for k in range(WORDS)])

    quarter, half = F.lit(0x0001000100010001), F.lit(0x0000FFFF0000FFFF)
    lane = lambda k, j: F.shiftrightunsigned(f"_h{k}", j).bitwiseAND(quarter) * F.col("_votes")
    sums = [F.sum(lane(k, j)).alias(f"_s{k}_{j}") for k in range(WORDS) for j in range(16)]
    chunks = each.groupBy(*keys, "_chunk").agg(F.sum("_votes").alias("_all"), *sums)
    # Sum j holds bits j, j + 16, j + 32 and j + 48; the halves hold bits j and j + 32.
    wide = lambda k, j: F.shiftrightunsigned(f"_s{k}_{j % 16}", 16 * (j // 16)).bitwiseAND(half)
    counted = chunks.groupBy(*keys).agg(F.sum("_all").alias("_all"), *[F.sum(wide(k, j)).alias(f"_w{k}_{j}") for k in range(WORDS) for j in range(32)])

    # In each half twice the votes for a bit, less all votes, plus 2^30: bit 30 tells the sign, and no half reaches the other.
    ones = F.lit(0x0000000100000001)
    signs = lambda k, j: F.shiftright(2 * F.col(f"_w{k}_{j}") + (F.lit(1 << 30) - F.col("_all")) * ones, 30).bitwiseAND(ones)

    def word(k: int) -> Column:
        out = signs(k, 0)
        for j in range(1, 32):
            out = out.bitwiseOR(F.shiftleft(signs(k, j), j))
        return out

    return counted.select(*keys, F.array(*[word(k) for k in range(WORDS)]).alias("simhash"))


def distance(a: str, b: str) -> Column:
    """Bits in which two fingerprints differ."""
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(WORDS)), F.lit(0))


def likeness(a: str, b: str) -> Column:
    """Share of equal bits: 1 for equal fingerprints, about 0.5 for unrelated texts."""
    return 1 - distance(a, b) / (64 * WORDS)


def digits(fingerprint: str) -> Column:
    """A fingerprint as hexadecimal digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.col(fingerprint)[k]), 16, "0") for k in range(WORDS)]))


def _blocks(fingerprint: str, count: int) -> list[Column]:
    """The fingerprint's bits in ``count`` blocks of (almost) equal length, as longs."""
    out, total = [], 64 * WORDS
    for i in range(count):
        first, last = total * i // count, total * (i + 1) // count
        value = F.lit(0).cast("long")
        for k in range(first // 64, (last - 1) // 64 + 1):
            low, high = max(first, 64 * k) - 64 * k, min(last, 64 * k + 64) - 64 * k
            mask = (1 << (high - low)) - 1
            part = F.shiftrightunsigned(F.col(fingerprint)[k], low)
            part = part if high - low == 64 else part.bitwiseAND(F.lit(mask))
            value = value.bitwiseXOR(F.shiftleft(part, 64 * k + low - first))
        out.append(value)
    return out


def near_fingerprints(queries: DataFrame, data: DataFrame, radius: int = RADIUS, spare: int = SPARE) -> DataFrame:
    """``query``, ``found`` and ``distance`` of all distinct fingerprints (``simhash``) of ``data`` within ``radius`` bits of one of ``queries``."""
    count = radius + spare
    if spare < 1 or count > 64 or any(64 * WORDS * (i + 1) // count - 64 * WORDS * i // count > 64 for i in range(count)):
        raise ValueError("blocks must be 1 to 64 bits long, and at least one must be spare")
    tables = list(combinations(range(count), spare))

    def keyed(side: DataFrame, name: str) -> DataFrame:
        side = side.filter("simhash is not null").select(F.col("simhash").alias(name)).distinct()
        side = side.withColumn("_blocks", F.array(*_blocks(name, count)))
        keys = [F.array(F.lit(t).cast("long"), *[F.col("_blocks")[i] for i in chosen]) for t, chosen in enumerate(tables)]
        return side.select(name, F.col("_blocks").alias(f"_{name}"), F.explode(F.array(*keys)).alias("_key"))

    agree = lambda i: F.col("_query")[i] == F.col("_found")[i]
    earlier = F.lit(False)
    for t, chosen in enumerate(tables):
        whole = F.lit(True)
        for i in chosen:
            whole = whole & agree(i)
        earlier = earlier | (whole & (F.col("a._key")[0] > t))
    a, b = keyed(queries, "query").alias("a"), keyed(data, "found").alias("b")
    near = (F.col("a._key") == F.col("b._key")) & (distance("query", "found") <= radius) & ~earlier
    return a.join(b, near).select("query", "found", distance("query", "found").alias("distance"))


def with_near_counts(found: DataFrame, is_query: Column, radius: int = RADIUS, spare: int = SPARE) -> DataFrame:
    """``found`` (``simhash``) with ``near_docs``: for queries the number of other rows within ``radius`` bits, for the others null."""
    asked = found.filter(is_query)
    copies = found.groupBy("simhash").agg(F.count(F.lit(1)).alias("_copies"))
    near = near_fingerprints(asked, copies, radius, spare).join(copies, F.col("found") == F.col("simhash"))
    near = near.groupBy("query").agg((F.sum("_copies") - 1).alias("near_docs"))
    told = asked.join(near.withColumnRenamed("query", "simhash"), "simhash", "left").select(*found.columns, "near_docs")
    return told.union(found.filter(~F.coalesce(is_query, F.lit(False))).withColumn("near_docs", F.lit(None).cast("long")))


def _chain(docs: DataFrame) -> DataFrame:
    """For each ``_id`` the ``_next`` smaller one (the largest after the smallest), and the ``_before`` it is next of with its ``_half``."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.groupBy("_id").agg(F.max(F.floor(F.char_length("_text") / 2)).alias("_half"))
    ids = write_table(ids.repartitionByRange(partitions, F.desc("_id")).withColumn("_piece", F.spark_partition_id()), "ids")
    # One row per piece: the ends of the pieces, and their neighbours in the ring of all pieces that have rows.
    ring = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = Window.orderBy("_piece")
    first, last = F.max(F.struct("_id", "_half")).alias("first"), F.min(F.struct("_id", "_half")).alias("last")
    ends = ids.groupBy("_piece").agg(first, last).select(
        "_piece",
        F.coalesce(F.lead("first").over(step), F.first("first").over(ring)).alias("_after"),
        F.coalesce(F.lag("last").over(step), F.last("last").over(ring)).alias("_prior"),
    )
    own = Window.partitionBy("_piece").orderBy(F.desc("_id"))
    ids = ids.withColumn("_following", F.lead("_id").over(own)).withColumn("_previous", F.lag(F.struct("_id", "_half")).over(own))
    ids = ids.join(ends, "_piece").withColumn("_previous", F.coalesce("_previous", "_prior"))
    following = F.coalesce("_following", F.col("_after._id")).alias("_next")
    return write_table(ids.select("_id", following, F.col("_previous._id").alias("_before"), F.col("_previous._half").alias("_half")), "chain")


def _identified(docs: DataFrame) -> DataFrame:
    """``_id`` (never null), ``_text`` and ``_row``, a number of the row that is odd if it has no ``doc_id``.

    Both sides of the join of texts and next texts use just these columns, so that Spark shuffles the texts once for the two.
    """
    text, no_id = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"), F.col("doc_id").isNull()
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST_ID)).alias("_id")
    return docs.select(key, text, (2 * F.monotonically_increasing_id() + no_id.cast("int")).alias("_row"))


def edited_texts(docs: DataFrame, chain: DataFrame) -> DataFrame:
    """``docs`` as made by ``_identified``, partitioned by ``_id``, with ``_edited``: the last half of each text replaced by as much of the next text."""
    start = F.struct(F.xxhash64("_text").alias("hash"), F.substring("_text", F.lit(1), F.col("_half").cast("int")).alias("text"), "_row")
    starts = docs.join(chain, "_id").select(F.col("_before").alias("_id"), start.alias("_start"))
    starts = starts.groupBy("_id").agg(F.max("_start")["text"].alias("_start"))
    both = docs.join(starts, "_id").withColumn("_n", F.char_length("_text").cast("long"))
    half = F.floor(F.col("_n") / 2).cast("int")
    kept = F.substring("_text", F.lit(1), F.col("_n").cast("int") - half)
    return both.withColumn("_edited", F.concat(kept, F.substring("_start", F.lit(1), half))).drop("_start")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, and the fingerprints of each text (``simhash``), of its edited text (``edited``) and of the
    next document's text (``following``) for ``docs`` (``doc_id``, ``text``)."""
    docs = _identified(docs)
    chain = _chain(docs)
    texts = edited_texts(docs, chain)
    both = F.array(F.struct(F.lit(False).alias("edited"), F.col("_text").alias("body")), F.struct(F.lit(True).alias("edited"), F.col("_edited").alias("body")))
    told = texts.select("_id", "_row", "_n", F.xxhash64("_text").alias("_hash"), F.unhex(F.sha2("_edited", 256)).alias("_sha"), F.inline_outer(both))
    keys = ["_id", "_row", "_n", "_hash", "_sha"]
    found = fingerprints(told, [*keys, "edited"], "body")
    of = lambda edited: F.max(F.when(F.col("edited") == edited, F.col("simhash")))
    found = write_table(found.groupBy(*keys).agg(of(False).alias("simhash"), of(True).alias("edited")), "fingerprints")
    first = found.groupBy("_id").agg(F.max(F.struct("_hash", "simhash"))["simhash"].alias("following"))
    first = first.join(chain.select(F.col("_before").alias("_to"), "_id"), "_id").select(F.col("_to").alias("_id"), "following")
    doc_id = F.when(F.col("_row") % 2 == 0, F.col("_id")).alias("doc_id")
    return found.join(first, "_id").select(doc_id, F.col("_n").alias("n_chars"), F.lower(F.hex("_sha")).alias("edited_sha256"), "simhash", "edited", "following")
