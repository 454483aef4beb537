"""Substring dedup by recompression: repeated stretches of words show up as shared symbols.

Recompression renames a text bottom up.  First runs of one word become a symbol each
(word and length); then, round by round, the symbols are split into left and right
ones by a bit of their names, and every left symbol followed by a right one becomes
a pair with a new name.  A name follows from what it stands for alone (a hash), so
all tasks give the same names without exchange.  Whether a symbol arises depends on
a few neighbouring words, its extent; hence equal stretches hold equal symbols,
except near their ends.

1. One pass over the texts: of the symbols whose extent lies in a window of
   ``window`` words, the one with the smallest hashed name stands for the window
   (its anchor; symbols of the last round first, words as a last resort); the words
   of its extent become part of the name.  The same window has the same anchor
   wherever it stands, and neighbouring windows share theirs: a text has far fewer
   anchors than words.
2. Spark brings equal names together: only names that several documents hold are of
   interest.
3. A second pass over the texts gives such an anchor's whole stretch (all its
   windows together) and its windows a hash of their words.  A stretch that a
   smaller document holds is settled at once.  Windows of the other stretches are
   compared one by one, where a name still has unsettled stretches in several
   documents.  A window always finds its smallest document: there it is unsettled.
4. The words under such windows go.

Equality is decided by 64 bits of the name and 64 bits of the words' own hash.  Long
texts are parsed in pieces that overlap by a window, which changes no anchor.

Rows: null text has no words; a null doc_id is neither smaller nor larger than
another, so such rows keep all words and take none; rows of equal doc_id do not
remove each other's words; a text shorter than the window keeps its words; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pumpline.llm.common import chunks, discard, ready, save
from pumpline.llm.tokens import ASIS, word_hashes

WINDOW = 13
#: Rounds of pairs.
ROUNDS = 2
#: Bytes of texts, and words of a piece, parsed at once.
BYTES = 1 << 20
PIECE = 1 << 17


ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def levels(words: np.ndarray, text: np.ndarray, rounds: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(name, low, high) of the symbols of each level: words, runs, then every round of pairs.

    ``text`` numbers the text of each word.  [low, high) is a symbol's extent in
    words; where it needs to know what a text's end hides, it reaches beyond.  Both
    ends rise from symbol to symbol.
    """
    n = len(words)
    name, at = _mix(words), np.arange(n)
    out = [(name, at, at + 1)]
    fresh = np.ones(n, bool)
    fresh[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    end = np.append(first[1:], n)
    count = (end - first).astype(np.uint64)
    name, text = name[first], text[first]
    name = np.where(count > 1, _mix(name + count * ODD), name)
    low, high = first - 1, end + 1
    out.append((name, low, high))
    for r in range(rounds):
        right = (_mix(name + np.uint64(0x51ED270B * (r + 1))) >> np.uint64(63)).astype(bool)
        joined = np.append(text[1:] == text[:-1], False)  # to the next symbol of the text
        pair = joined & ~right & np.append(right[1:], False)
        taken = np.append(False, pair[:-1])
        follows = np.append(False, joined[:-1])
        next_name, next_high, next_end = np.roll(name, -1), np.roll(high, -1), np.roll(end, -1)
        # what stays alone does so because of the neighbour it could have joined
        new_low = np.where(right & ~taken, np.where(follows, np.roll(low, 1), first - 1), low)
        new_high = np.where(pair | (~right & joined), next_high, np.where(right, high, np.maximum(high, end + 1)))
        new_name = np.where(pair, _mix(name * np.uint64(0xD6E8FEB86659FD93) + next_name), name)
        stay = ~taken
        end = np.where(pair, next_end, end)[stay]
        name, low, high, first, text = new_name[stay], new_low[stay], new_high[stay], first[stay], text[stay]
        out.append((name, low, high))
    return out


def anchors(words: np.ndarray, n_words: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """(name, first window, last window, text) of the anchors; windows are numbered by their first word."""
    text = np.repeat(np.arange(len(n_words)), n_words)
    none = np.zeros(0, np.int64)
    start = np.flatnonzero(text[:len(text) - window + 1] == text[window - 1:]) if len(words) >= window else none
    if not len(start):
        return np.zeros(0, np.uint64), none, none, none
    best_name, best_at = np.zeros(len(start), np.uint64), np.full(len(start), -1)
    # hash of any stretch: the difference of two running sums of words times powers, brought back to power 0
    power = np.cumprod(np.full(len(words), ODD, np.uint64))
    back = np.cumprod(np.full(len(words), np.uint64(pow(int(ODD), -1, 1 << 64)), np.uint64))
    total = np.append(np.uint64(0), np.cumsum(words * power))
    todo = np.arange(len(start))
    for level, (name, low, high) in reversed(list(enumerate(levels(words, text, rounds)))):
        key = _mix(name ^ np.uint64(level))
        s = start[todo]
        lo, hi = np.searchsorted(low, s), np.searchsorted(high, s + window, side="right")
        some = hi > lo
        todo, lo, hi = todo[some], lo[some], hi[some]
        least, at = key[lo], lo.copy()
        for k in range(1, int((hi - lo).max(initial=0))):
            own = np.flatnonzero(lo + k < hi)
            j = lo[own] + k
            less = key[j] < least[own]
            least[own[less]], at[own[less]] = key[j[less]], j[less]
        # the extent's words are as fixed as the symbol, and tell more; equal words in a row are one anchor
        best_name[todo] = _mix(least ^ ((total[high[at]] - total[low[at]]) * back[low[at]])) if level else least
        best_at[todo] = (at if level else 0) * 64 + level
        todo = np.flatnonzero(best_at < 0)
        if not len(todo):
            break
    new = np.ones(len(start), bool)
    new[1:] = (best_at[1:] != best_at[:-1]) | (best_name[1:] != best_name[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return best_name[first], start[first], start[last], text[start[first]]


def text_anchors(texts: list[bytes], window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(name as a signed long, first window, last window) of each text's anchors."""
    h, n = word_hashes(texts, ASIS)
    begin = np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else n
    out: list[list] = [[] for _ in texts]
    # pieces as (text, first word, words); they share window - 1 words
    pieces = [(i, lo, min(PIECE, c - lo)) for i, c in enumerate(n.tolist()) for lo in range(0, max(1, c - window + 1), PIECE - window + 1)]
    for part in chunks(pieces, lambda p: p[2], PIECE):
        words = np.concatenate([h[begin[i] + lo:begin[i] + lo + c] for i, lo, c in part])
        sizes = np.array([c for _, _, c in part])
        offset = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        name, a, b, of = anchors(words, sizes, window)
        edge = np.searchsorted(of, np.arange(len(part) + 1))
        for k, (i, lo, _) in enumerate(part):
            own = slice(edge[k], edge[k + 1])
            out[i].append((name[own].view(np.int64), a[own] - offset[k] + lo, b[own] - offset[k] + lo))
    return [tuple(np.concatenate(x) for x in zip(*parts)) for parts in out]


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, k, text): a row is known by its id and its text's hash; equal rows have equal results."""
    text = F.col("text").cast("string").cast("binary")
    return docs.select("doc_id", F.xxhash64(text).alias("k"), text.alias("text"))


def _shared(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that several documents hold, with the smallest one (combined before the shuffle)."""
    return df.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most")


def _parse(window: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, kept, found = b.column(2).to_pylist(), [], []
            for part in chunks(range(b.num_rows), lambda i: len(raw[i]), BYTES):
                kept += part
                found += text_anchors([raw[i] for i in part], window)
            name, first, last = zip(*found) if found else ((), (), ())
            lists = [pa.array([x.tolist() for x in col], kind) for col, kind in ((name, pa.list_(pa.int64())), (first, pa.list_(pa.int32())), (last, pa.list_(pa.int32())))]
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *lists], ["doc_id", "k", "name", "first", "last"])
    return parse


def _stretches(window: int):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        signed = lambda v: v - (1 << 64) if v >> 63 else v
        for b in batches:
            at, name, stretch, first, wins = [], [], [], [], []
            for i, (text, own) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                words = text.split()
                flat = b" ".join(words)
                end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                begin = np.concatenate(([0], end[:-1] + 1)).tolist()
                end = end[window - 1:].tolist()
                for r in own:
                    lo, hi = r["first"], r["last"]
                    at.append(i)
                    name.append(r["name"])
                    first.append(lo)
                    stretch.append(signed(digest(flat[begin[lo]:end[hi]])))
                    wins.append([signed(digest(flat[begin[j]:end[j]])) for j in range(lo, hi + 1)])
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(name, pa.int64()), pa.array(stretch, pa.int64()), pa.array(first, pa.int32()),
                 pa.array(wins, pa.list_(pa.int64()))], ["doc_id", "k", "name", "stretch", "first", "windows"])
    return look


def repeated(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, k, ranges): for each text the windows (first, last) that a smaller document holds too; saved."""
    rows = _rows(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = rows.where("doc_id is not null and text is not null")
    parsed = save(spark, texts.mapInArrow(_parse(window), f"doc_id {kind}, k long, name array<long>, first array<int>, last array<int>"), "anchors")
    each = parsed.select("doc_id", "k", F.explode(F.arrays_zip("name", "first", "last")).alias("r")).select("doc_id", "k", "r.*")
    names = save(spark, _shared(each.select("doc_id", "name"), "name").select("name"), "anchor-names")
    held = save(spark, each.join(names, "name"), "anchors-shared")
    discard(spark, parsed, names)
    of_text = held.groupBy("doc_id", "k").agg(F.collect_set(F.struct("name", "first", "last")).alias("own"))
    seen = texts.join(of_text, ["doc_id", "k"]).select("doc_id", "k", "text", "own").mapInArrow(
        _stretches(window), f"doc_id {kind}, k long, name long, stretch long, first int, windows array<long>")
    seen = save(spark, seen, "stretches")
    discard(spark, held)
    # stretches that a smaller document holds whole
    whole = save(spark, _shared(seen, "name", "stretch"), "stretches-shared")
    settled = F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False))
    marked = seen.join(whole, ["name", "stretch"], "left").select(
        "doc_id", "k", "name", "first", (F.col("first") + F.size("windows") - 1).alias("last"), F.when(~settled, F.col("windows")).alias("windows"))
    marked = save(spark, marked, "stretches-marked")
    discard(spark, seen, whole)
    done = marked.where("windows is null").select("doc_id", "k", F.struct("first", "last").alias("r"))
    # the others, window by window, where a name is still held by several documents
    rest = marked.where("windows is not null")
    open_names = save(spark, _shared(rest, "name").select("name"), "names-open")
    single = rest.join(open_names, "name").select("doc_id", "k", "name", "first", F.posexplode("windows").alias("j", "w"))
    single = save(spark, single.select("doc_id", "k", "name", "w", (F.col("first") + F.col("j")).alias("at")), "windows")
    both = save(spark, _shared(single, "name", "w"), "windows-shared")
    hits = single.join(both, ["name", "w"]).where("least < doc_id").select("doc_id", "k", F.struct(F.col("at").alias("first"), F.col("at").alias("last")).alias("r"))
    out = save(spark, done.unionByName(hits).groupBy("doc_id", "k").agg(F.collect_set("r").alias("ranges")), "repeated")
    discard(spark, marked, open_names, single, both)
    return out


def dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, kept text, n_words, n_removed) of every row; the kept words are joined by one space."""
    ready(spark)
    found = repeated(spark, docs, window)
    schema = StructType([docs.schema["doc_id"], StructField("kept", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, total, gone = [], [], []
            for text, own in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = (text or b"").split()
                total.append(len(words))
                if own:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [r["first"] for r in own], 1)
                    np.add.at(edge, [r["last"] + window for r in own], -1)
                    covered = np.cumsum(edge[:-1]) > 0
                    words = [w for w, c in zip(words, covered.tolist()) if not c]
                kept.append(b" ".join(words))
                gone.append(total[-1] - len(words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             names=["doc_id", "kept", "n_words", "n_removed"])

    joined = _rows(docs).join(found, ["doc_id", "k"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(cut, schema)


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns."""
    return dedup(spark, docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: Every window as a text: the plain form of the same question.
ORACLE = r"""WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT rid, doc_id, unnest(range(1, len(words) - 11)) AS pos, words FROM d WHERE len(words) >= 13),
s AS (SELECT rid, doc_id, pos, sha256(array_to_string(words[pos:pos + 12], ' ')) AS h FROM w),
hit AS (SELECT rid, pos FROM s JOIN (SELECT h, min(doc_id) AS least FROM s GROUP BY h) m USING (h) WHERE least < doc_id),
gone AS (SELECT DISTINCT rid, pos + j AS pos FROM hit, range(13) r(j)),
g AS (SELECT rid, list(pos) AS pos FROM gone GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(len(pos), 0) AS n_removed,
  sha256(CASE WHEN pos IS NULL THEN array_to_string(words, ' ') ELSE array_to_string(list_filter(words, lambda x, i: NOT list_contains(pos, i)), ' ') END) AS kept_sha256
FROM d LEFT JOIN g USING (rid)"""
