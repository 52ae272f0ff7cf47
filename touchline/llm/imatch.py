"""Fingerprints of documents by I-Match: the terms of a band of document frequencies,
hashed as a whole for each of several random parts of that lexicon.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch
from touchline.llm.ranks import ranked

#: Least and largest share of all documents that a term of the lexicon is in, and the least
#: number of them. Inverse document frequencies run from log(1 / MOST) to log(1 / LEAST).
LEAST, MOST, LEAST_DOCS = 0.0005, 0.02, 2
#: Hashes that terms are told apart by. A document's terms are few beside them, so what shares
#: the hash of a term of the lexicon adds a share far below LEAST, at any number of documents.
HASHES = 1 << 24
#: Random parts that the lexicon falls into, rates that a fingerprint tells of, and the last
#: rate: each keeps half of the terms that the one before keeps.
PARTS, RATES, LAST_RATE = 16, 4, 20
WORD = r"[\p{L}\p{M}\p{N}]+"


def _hashes(text: Column) -> Column:
    """The distinct hashes of a text's terms: lower-cased runs of letters, marks and digits."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.array_distinct(F.transform(words, lambda x: F.xxhash64(x).bitwiseAND(F.lit(HASHES - 1))))


def _within(term: Column) -> Column:
    """The place of a hash's bit among the 64 of its number."""
    return term.bitwiseAND(F.lit(63)).cast("int")


def fit_lexicon(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """One row with ``bits``: an array of HASHES bits, 64 in each number, set for hashes of
    terms in the band.

    Every row of ``texts`` (text) counts, copies too. Few terms reach the least share, at most
    the mean number of a document's terms / LEAST, so the bits hold them apart at any number
    of documents.
    """
    total = texts.count()
    counts = texts.select(F.explode(_hashes(F.col("text"))).alias("term")).groupBy("term").count()
    fewest, most = max(LEAST_DOCS, LEAST * total), max(LEAST_DOCS, MOST * total)
    known = counts.filter(F.col("count").between(fewest, most))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _within(F.col("term")))
    words = scratch.write(
        known.groupBy(F.shiftright("term", 6).alias("id")).agg(F.bit_or(bit).alias("bits"))
    )
    every = texts.sparkSession.range(HASHES // 64).join(words, "id", "left")
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return scratch.write(every.agg(pairs.alias("pairs")).select(F.col("pairs.bits").alias("bits")))


def with_fingerprint(rows: DataFrame, text: str, lexicon: DataFrame, name: str) -> DataFrame:
    """``rows`` and the fingerprint of the column ``text``.

    The lexicon falls into PARTS random parts, and each rate keeps a random half of the terms
    that the one before keeps. A text's fingerprint has one hash for each part and each of
    RATES rates that hold terms of it: of the rate, the part and the sorted terms. The first
    rate depends on the number of the text's terms, such that one or two of them are left in
    a part. A text without a term of the lexicon has its own digest instead, so that only
    equal ones agree.
    """

    def listed(term: Column) -> Column:
        word = F.get(F.col("lexicon bits"), F.shiftright(term, 6).cast("int"))
        return F.getbit(word, _within(term)) == 1

    # The bits are a constant that the optimizer puts in where they are used once.
    terms, rate, parts = f"{name} terms", f"{name} rate", f"{name} parts"
    found = rows.withColumn("lexicon bits", lexicon.select("bits").scalar())
    # Hashed once more: the last bits of the new hash tell the part, those before it the rate.
    kept = F.transform(F.filter(_hashes(F.col(text)), listed), lambda x: F.xxhash64(x))
    found = found.withColumn(terms, F.array_sort(kept)).drop("lexicon bits")
    size = F.greatest(F.size(terms) / F.lit(PARTS), F.lit(1.0))
    found = found.withColumn(rate, F.least(F.floor(F.log2(size)), F.lit(LAST_RATE)).cast("int"))

    def drawn(some: Column, rate: Column) -> Column:
        """The terms that a rate keeps: those whose hash has as many zeros there."""
        zeros = (F.call_function("shiftleft", F.lit(PARTS).cast("long"), rate) - PARTS).cast("long")
        return F.filter(some, lambda x: x.bitwiseAND(zeros) == 0)

    def within(some: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(PARTS - 1)),
            lambda i: F.filter(some, lambda x: x.bitwiseAND(F.lit(PARTS - 1)) == i),
        )

    def hashed(some: Column, rate: Column, part: Column) -> Column:
        value = F.xxhash64(rate, part, some).bitwiseAND(F.lit((1 << 32) - 1))
        # One more digit in front keeps zeros; it is cut off.
        return F.when(F.size(some) > 0, F.substring(F.hex(value.bitwiseOR(F.lit(1 << 32))), 2, 8))

    found = found.withColumn(parts, within(drawn(F.col(terms), F.col(rate))))
    hashes = F.flatten(
        F.transform(
            F.sequence(F.col(rate), F.col(rate) + (RATES - 1)),
            lambda r: F.transform(F.col(parts), lambda some, i: hashed(drawn(some, r), r, i)),
        )
    )
    # array_join leaves out nulls, which stand for parts without a term.
    joined, whole = F.array_join(hashes, " "), F.concat(F.lit("="), F.md5(F.col(text)))
    fingerprint = F.when(joined == "", whole).otherwise(joined)
    return found.withColumn(name, fingerprint).drop(terms, rate, parts)


def likeness(a: Column, b: Column) -> Column:
    """The share of the hashes of two fingerprints that both have: 1 for equal ones."""
    first, second = F.split(a, " "), F.split(b, " ")
    both = F.size(F.array_intersect(first, second)).cast("double")
    return both / F.size(F.array_union(first, second)).cast("double")


def _halves(docs: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """Rows with doc_id, place, total, n_chars, text, edited, times and own.

    Each stands for ``times`` equal documents. Documents follow each other by doc_id, nulls
    first, then by a digest of id and text; of several equal rows all but the last one are
    followed by an equal one, which ``own`` tells. Only ids, lengths and digests are ranked.
    A text is shuffled once, by its digest, and its first half once more, to the document
    before it.
    """
    text = F.coalesce("text", F.lit(""))
    named = F.coalesce(F.col(key).cast("string"), F.lit("-"))
    rows = docs.select(
        F.unhex(F.md5(F.concat(named, F.lit(" "), text))).alias("id"),
        F.col(key).alias("doc_id"),
        text.alias("text"),
    )
    narrow = rows.groupBy("id").agg(
        F.max("doc_id").alias("doc_id"),
        F.max(F.char_length("text").cast("long")).alias("n_chars"),
        F.count("*").alias("copies"),
    )
    placed = scratch.write(ranked(narrow, ["doc_id", "id"], scratch))
    before = placed.select(
        F.pmod(F.col("place") + 1, "total").alias("place"),
        F.col("id").alias("previous"),
        F.floor(F.col("n_chars") / F.lit(2)).cast("int").alias("wanted"),
    )
    links = scratch.write(placed.join(before, "place"))
    # Both sides of the join below start with this one shuffle of the texts.
    texts = rows.groupBy("id").agg(F.first("text").alias("text")).join(links.hint("merge"), "id")
    half = F.floor(F.col("n_chars") / F.lit(2)).cast("int")
    heads = texts.select(
        F.col("previous").alias("id"), F.substring("text", F.lit(1), F.col("wanted")).alias("head"),
        F.lit(1).cast("long").alias("times"), F.lit(False).alias("own"),
    )
    again = texts.filter("copies > 1").select(
        "id", F.substring("text", F.lit(1), half).alias("head"), (F.col("copies") - 1).alias("times"), F.lit(True).alias("own"),
    )
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    return texts.join(heads.unionByName(again).hint("merge"), "id").select(
        "doc_id", "place", "total", "n_chars", "text", F.concat(kept, "head").alias("edited"), "times", "own"
    )


def fingerprints(docs: DataFrame, scratch: Scratch, key: str = "doc_id") -> DataFrame:
    """Fingerprints of every document and of its edited text, and what they are like.

    Returns the key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. The edited text ends, in place of its last floor(n_chars / 2) characters, with
    as many first ones of the next document. Null texts count as empty; an empty text's
    fingerprint agrees with that of empty texts only. Equal texts have equal fingerprints,
    and the lexicon is that of all documents. Repeated rows repeat; an empty table gives no
    rows; other columns are ignored. Ties of the key follow each other by a digest of the text.
    """
    lexicon = fit_lexicon(docs.select(F.coalesce("text", F.lit("")).alias("text")), scratch)
    rows = _halves(docs, key, scratch)
    rows = with_fingerprint(rows, "text", lexicon, "fingerprint")
    rows = with_fingerprint(rows, "edited", lexicon, "edited_fingerprint")
    done = scratch.write(
        rows.withColumn("edited_sha256", F.sha2("edited", 256)).drop("text", "edited")
    )
    following = done.filter(~F.col("own")).select(
        F.pmod(F.col("place") + F.col("total") - 1, "total").alias("place"), F.col("fingerprint").alias("following")
    )
    after = F.when(F.col("own"), F.col("fingerprint")).otherwise(F.col("following"))
    return (
        done.join(following, "place")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
        .select(
            F.col("doc_id").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), after).alias("near_next"),
        )
    )
