"""SimHash near-duplicates found through Golay-code fuzzy hashing.

Fingerprints of 64 bits are cut into three segments (22, 21 and 21 bits).  If
two fingerprints differ in at most two bits, then going round the three segments
there is always one that agrees exactly while the next one differs in at most
one bit (every split of two errors over three segments is covered by the pairs
1->2, 2->3, 3->1).  The key of a pair (i, j) is therefore the exact value of
segment i with an index that tolerates an error in segment j: the segment is
taken as a word of the perfect binary Golay code of length 23, and its indices
are the nearest codeword and, where that lies three bits away, the five
codewords at four bits.  Two words one bit apart always share such a codeword.

Distinct fingerprints meet on these keys and the bit distance decides.  A key
shared by more than ``bucket`` fingerprints is not joined pairwise: there every
fingerprint is sent to the 65 words at distance 0 or 1; two fingerprints within
two bits meet in at least one of them, and all that meet in one are within two
bits, so one star per word keeps every connection (linear, exact, no cap).

Rows: null text counts as empty; a text without words has fingerprint zero and
links like any other; equal fingerprints always share a component; an empty
table gives no rows; extra columns are ignored; null doc_ids are skipped when
the smallest id of a component is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pumpline.llm.common import components, names, numbered, ready, save

#: Segments as (lowest bit, number of bits), and the pairs (exact, tolerant).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
ROUND = ((0, 1), (1, 2), (2, 0))

#: Generator polynomial of the perfect binary Golay code of length 23:
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101

#: The eight bits, highest first, of each byte value.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | str | None, shingle: int = 3, seed: int = 42, step: int = 65536) -> int:
    """SimHash of a whole text as an unsigned 64-bit integer.

    Words are split at ASCII white space after lower-casing A-Z, joined by one
    space; a text of fewer than ``shingle`` words is one shingle.  Shingle hashes
    are counted ``step`` at a time, so memory follows the text, not its square.
    """
    if not text:
        return 0
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    first, last = starts[:n].tolist(), ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros((8, 8), np.int64)
    for lo in range(0, n, step):
        hs = b"".join([digest(flat[a:b], seed) for a, b in zip(first[lo:lo + step], last[lo:lo + step])])
        by_byte = np.frombuffer(hs, np.uint8).reshape(-1, 8)  # big-endian digests
        for k in range(8):  # a histogram of each byte's values gives the counts of its eight bits
            ones[k] += np.bincount(by_byte[:, k], minlength=256) @ BITS
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each byte position's value, and per syndrome the error words (0-padded count).

    For each of the 2048 syndromes: the difference words that lead from a word
    with this syndrome to the codewords its keys name.
    """
    rem = []
    for i in range(23):  # x^i modulo the generator
        r = 1 << i
        for b in range(22, 10, -1):
            if r >> b & 1:
                r ^= GOLAY << (b - 11)
        rem.append(r)
    near: dict[int, int] = {0: 0}
    lists: dict[int, list[int]] = {}
    by_weight: list[list[tuple[int, int, int]]] = [[(0, 0, -1)]]  # (word, syndrome, highest bit)
    for _ in range(4):
        by_weight.append([(w | 1 << i, s ^ rem[i], i) for w, s, top in by_weight[-1] for i in range(top + 1, 23)])
    for weight in (1, 2, 3):
        for w, s, _ in by_weight[weight]:
            near[s] = w
    for w, s, _ in by_weight[4]:
        lists.setdefault(s, []).append(w)
    out = np.full((2048, 6), -1, np.int64)
    for s, w in near.items():
        own = [w, *(lists.get(s, []) if w.bit_count() == 3 else [])]
        out[s, :len(own)] = own
    low = np.zeros((3, 256), np.int64)
    for part in range(3):
        for v in range(256):
            for b in range(8):
                if v >> b & 1 and 8 * part + b < 23:
                    low[part, v] ^= rem[8 * part + b]
    return low, out


def golay_indices(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices of 23-bit words, -1 where a word has fewer."""
    low, errors = _golay()
    w = words.astype(np.int64)
    syndrome = low[0, w & 255] ^ low[1, w >> 8 & 255] ^ low[2, w >> 16 & 127]
    e = errors[syndrome]
    return np.where(e < 0, -1, (w[:, None] ^ e) >> 11)


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys): the Golay keys of unsigned fingerprints, each with its row's position."""
    u = fps.astype(np.uint64)
    seg = [((u >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]
    at, keys = [], []
    for k, (exact, loose) in enumerate(ROUND):
        idx = golay_indices(seg[loose])
        row, col = np.nonzero(idx >= 0)
        keys.append((k << 34) | (seg[exact][row] << 12) | idx[row, col])
        at.append(row)
    return np.concatenate(at), np.concatenate(keys)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        at, keys = golay_keys(fp.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[at])], ["key", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3, rid: str | None = None) -> DataFrame:
    """(rid, doc_id, fp): a row number, the id and the signed 64-bit fingerprint of each row of ``docs``.

    ``rid`` keeps rows apart that are equal in every column: the column of that
    name, or else a number that holds for this one evaluation only.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(2).cast(pa.binary()) if b.num_rows else b.column(2)
            fp = np.array([fingerprint(x.as_py(), shingle) for x in text], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["rid", "doc_id", "fp"])

    number = F.monotonically_increasing_id() if rid is None else F.col(rid)
    src = docs.select(number.alias("rid"), F.col("doc_id"), F.col("text").cast("string").alias("text"))
    schema = StructType([StructField("rid", LongType()), StructField("doc_id", docs.schema["doc_id"].dataType),
                         StructField("fp", LongType())])
    return src.mapInArrow(rows, schema)


def links(spark: SparkSession, fps: DataFrame, max_bits: int = 2, bucket: int = 32) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all pairs within 2 bits.

    ``fps``: distinct long fingerprints in column fp.  ``max_bits`` may be 0, 1 or 2
    (the scheme's guarantee); hot keys use neighbour words of half that distance.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the key scheme guarantees distances of at most 2 bits")
    keys = save(spark, fps.select("fp").mapInArrow(_key_rows, "key long, fp long"), "golay-keys")
    sizes = save(spark, keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "golay-sizes")
    small = keys.join(sizes.where(F.col("n") <= bucket).select("key"), "key")
    small = save(spark, small, "golay-small")
    a, b = small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    near = a.join(b, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    pairs = near.select("a", "b")
    hot = keys.join(sizes.where(F.col("n") > bucket).select("key"), "key").select("fp").distinct()
    if max_bits == 2:
        flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]
        balls = hot.select("fp", F.explode(F.array(*flips)).alias("mid"))
        stars = balls.groupBy("mid").agg(F.collect_list("fp").alias("m")).where("size(m) > 1")  # 65 at most
        pairs = pairs.unionByName(stars.select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a <> b"))
    elif max_bits == 1:
        flips = [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]
        there = hot.select(F.col("fp").alias("a"), F.explode(F.array(*flips)).alias("b"))
        pairs = pairs.unionByName(there.join(hot.select(F.col("fp").alias("b")), "b", "left_semi").where("a < b").select("a", "b"))
    return pairs.distinct()


def simhash_groups(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                   bucket: int = 32, rid: str | None = None) -> DataFrame:
    """(rid, doc_id, fp, component_id, keep) for every row: component_id is the smallest doc_id reachable.

    ``keep`` marks one row of each component: the smallest doc_id (null last), of equal ids the first row.
    """
    ready(spark)
    sig = save(spark, fingerprints(docs, shingle, rid), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("rid")))
    reps = save(spark, sig.groupBy("fp").agg(first.alias("first")), "simhash-reps")
    roots = components(spark, links(spark, reps, max_bits, bucket))
    rooted = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    rooted = save(spark, rooted, "simhash-rooted")
    firsts = save(spark, rooted.groupBy("root").agg(F.min("first").alias("best")), "simhash-first")
    by_fp = save(spark, rooted.select("fp", "root").join(firsts, "root")
                 .select("fp", F.col("best.id").alias("component_id"), F.col("best.rid").alias("keep_rid")), "simhash-by-fp")
    return sig.join(by_fp, "fp").select("rid", "doc_id", "fp", "component_id", (F.col("rid") == F.col("keep_rid")).alias("keep"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each near-copy group, with the columns of ``docs``.

    The rows are numbered and saved first: the number must be the same when the
    kept ones are picked out.
    """
    rows, rid = numbered(spark, docs, "near-copies-rows")
    kept = simhash_groups(spark, rows, shingle, max_bits, rid=rid).where("keep").select(F.col("rid").alias(rid))
    return rows.join(kept, rid, "left_semi").select(*names(docs))


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns: doc_id, fingerprint (16 hex digits), component_id."""
    g = simhash_groups(spark, docs)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
