"""Document fingerprints by winnowing.

A text is a row of units: its words, and the single letters of words too long to be words (scripts without spaces). Hashes of
five units in a row roll along the text; of every eight hashes in a row the least is kept, the rightmost of equal ones, with
its position. Texts that share twelve units in a row share a kept hash, wherever the passage stands. All of it is built of
DataFrame functions, row by row; a text meets no other to be fingerprinted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import bind, item_words, row_key, written
from tidelog.plans import scans
from tidelog.plans.once import compute_once

#: Units of a hash, and hashes of a window: a power of two.
UNITS, WINDOW = 5, 8
#: A word of more letters counts as its letters.
LONG_WORD = 24
#: Hashes have 60 bits. Their upper 32 order them, over 31 bits for the position counted from the right.
BITS, ORDER_BITS, PLACE_BITS = 60, 32, 31
LAST_PLACE = (1 << PLACE_BITS) - 1
#: Documents of consecutive ids that one task puts in order.
ORDERED_ROWS = 20_000


def units(text: Column) -> Column:
    """Lower-cased words, long ones as letters. A text without any is one unit, an empty one has none."""
    letters = lambda w: F.when(F.char_length(w) > LONG_WORD, F.split(w, "")).otherwise(F.array(w))
    return bind(item_words(text), lambda words: F.when((F.size(words) > 0) | (text == ""), F.when(
        F.exists(words, lambda w: F.char_length(w) > LONG_WORD), F.flatten(F.transform(words, letters))).otherwise(words)).otherwise(F.array(text)))


def unit_hash(unit: Column) -> Column:
    """The CRC-32 of the unit's UTF-8, then the upper 28 bits of that of its Base64. Both are cheap, and units that share one differ in the other."""
    return F.shiftleft(F.crc32(unit.cast("binary")), 28).bitwiseOR(F.shiftright(F.crc32(F.base64(unit.cast("binary")).cast("binary")), 4))


def _turned(x: Column, by: int) -> Column:
    """Sixty bits rotated to the left."""
    return F.shiftleft(x.bitwiseAND(F.lit((1 << (BITS - by)) - 1)), by).bitwiseOR(F.shiftright(x, BITS - by))


def rolling_hashes(hashes: Column) -> Column:
    """Cyclic hashes of every five units in a row: the exclusive or of the unit hashes, rotated by their distance from the end.

    They roll by doubling: hashes of one unit make those of two, these those of four. Fewer units make one hash together.
    """
    def step(left: Column, by: int, right: Column) -> Column:
        return F.transform(left, lambda x, i: _turned(x, by).bitwiseXOR(F.get(right, i + by)))

    few = F.array(F.aggregate(hashes, F.lit(0).cast("long"), lambda so_far, x: _turned(so_far, 1).bitwiseXOR(x)))
    many = bind(step(hashes, 1, hashes), lambda two: bind(step(two, 2, two), lambda four: F.slice(
        F.transform(four, lambda x, i: _turned(x, 1).bitwiseXOR(F.get(hashes, i + 4))), F.lit(1), F.size(hashes) - (UNITS - 1))))
    return F.when(F.size(hashes) >= UNITS, many).when(F.size(hashes) > 0, few).otherwise(F.array().cast("array<long>"))


def winnowed(grams: Column) -> Column:
    """Positions and values of the least hash of each window, rightmost of equal ones: array<struct<pos, hash>> by position.

    Fewer hashes than a window has are one window.
    """
    def least(values: Column, by: int) -> Column:
        return F.transform(values, lambda x, i: F.least(x, F.coalesce(F.get(values, i + by), x)))

    placed = F.transform(grams, lambda g, i: F.shiftleft(F.shiftright(g, BITS - ORDER_BITS), PLACE_BITS).bitwiseOR(F.lit(LAST_PLACE).cast("long") - i))
    whole = lambda p: bind(least(p, 1), lambda two: bind(least(two, 2), lambda four: F.slice(least(four, 4), F.lit(1), F.size(p) - (WINDOW - 1))))
    kept = bind(placed, lambda p: F.array_distinct(F.when(F.size(p) > WINDOW, whole(p)).when(F.size(p) > 0, F.array(F.array_min(p))).otherwise(F.array().cast("array<long>"))))
    place = lambda k: (F.lit(LAST_PLACE).cast("long") - k.bitwiseAND(F.lit(LAST_PLACE).cast("long"))).cast("int")
    return F.transform(kept, lambda k: bind(place(k), lambda at: F.struct(at.alias("pos"), F.get(grams, at).alias("hash"))))


def fingerprint(text: Column) -> Column:
    """Kept hashes of a text with their positions, in units: array<struct<pos int, hash long>>. Empty for a null or empty text."""
    return bind(F.coalesce(text, F.lit("")), lambda t: bind(F.transform(units(t), unit_hash), lambda h: bind(rolling_hashes(h), winnowed)))


def hashes_of(prints: Column) -> Column:
    return F.array_distinct(F.transform(prints, lambda p: p["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    return bind(both, lambda n: F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(n / (F.size(a) + F.size(b) - n)))


def as_text(prints: Column) -> Column:
    """``position:hash`` with the hash in hexadecimal, comma-joined."""
    return F.array_join(F.transform(prints, lambda p: F.concat(p["pos"].cast("string"), F.lit(":"), F.lower(F.hex(p["hash"])))), ",")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_chars, prints (array<struct<pos, hash>>).

    Equal texts have equal prints, rows that repeat each a row, a null or empty text no prints, an empty table no rows. A text of
    fewer than five units has one print. Other columns, whatever their names, are not read.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.char_length(value).cast("long").alias("n_chars"), fingerprint(value).alias("prints"))


def passages(prints: DataFrame, by: str = "doc_id") -> DataFrame:
    """Kept hashes as rows, to be joined with those of other documents: the column ``by``, hash, pos."""
    return prints.select(by, F.inline("prints")).select(by, "hash", "pos")


def _successors(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, key, next_key, n_chars): each different document (doc_id, key, n_chars) and the one behind it by id; the first follows the last.

    Ids are put in order by chunks of consecutive ones; only the first document of each chunk meets the other chunks'.
    """
    each = written(docs.distinct())
    head = each.agg(F.min(F.struct("doc_id", "key"))).first()[0]
    cut = scans.with_chunk(each, "doc_id", "cut", ORDERED_ROWS)
    behind = scans.scan(cut, [], ["doc_id", "key"], F.coalesce("cut", F.lit(-1)), next_key=scans.following(F.col("key")))
    return behind.select("doc_id", "key", F.coalesce("next_key", F.lit(head["key"] if head else None)).alias("next_key"), "n_chars")


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside an edit of it: the last quarter of its code points makes way for the beginning of the next document.

    One row per row of docs: doc_id, text, edited, next_hashes (the distinct hashes kept of the next document). Documents go by id, a
    null one first, those that share an id by an MD5 of their text; rows that repeat both are one document, and each gets its
    result. A null text is empty. The last one is followed by the first, so a lone document follows itself.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = rows.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    follows = written(_successors(keyed.select("doc_id", "key", F.char_length("text").cast("long").alias("n_chars"))))
    wanted = follows.select(F.col("next_key").alias("key"), F.col("key").alias("for_key"), "doc_id", F.floor(F.col("n_chars") / 4).cast("int").alias("n"))
    # Rows that repeat say the same for the document before them: one of them is enough.
    # Both joins deal out the same two columns, so that the texts are shuffled once.
    keyed = keyed.select("key", "text")
    told = keyed.join(wanted, "key").select("for_key", F.struct(
        "doc_id", F.substr(F.col("text"), F.lit(1), F.col("n")).alias("head"), hashes_of(fingerprint(F.col("text"))).alias("hashes")).alias("next"))
    told = told.groupBy("for_key").agg(F.first("next").alias("next")).withColumnRenamed("for_key", "key")
    n = F.char_length("text")
    kept = F.substr(F.col("text"), F.lit(1), n - F.floor(n / 4).cast("int"))
    return keyed.join(told, "key").select(F.col("next.doc_id").alias("doc_id"), "text", F.concat(kept, F.col("next.head")).alias("edited"), F.col("next.hashes").alias("next_hashes"))


def near_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edit (see ``edited``), and how alike they are.

    One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    both = compute_once(edited(docs, doc_id, text), prints=fingerprint(F.col("text")), edited_prints=fingerprint(F.col("edited")))
    both = compute_once(both, hashes=hashes_of(F.col("prints")))
    return both.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("prints")).alias("fingerprint"),
        as_text(F.col("edited_prints")).alias("edited_fingerprint"), likeness(F.col("hashes"), hashes_of(F.col("edited_prints"))).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
