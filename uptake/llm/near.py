"""Near-duplicates: 64-bit SimHash of word shingles, linked by multi-index hashing.

Fingerprints a = (high, low) and b differ in two bits at most, so either their
high halves differ in one bit at most, or their low halves are equal. Each half is a
table; each fingerprint probes the high table with the ball of radius one around its own
half, and the low table with its half alone. A bucket of a half may hold many fingerprints
of one group of near copies, so the bits that are left are indexed again in the same
way, by 16-bit quarters; every match is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import chunks, numbered, row_order, written
from uptake.llm.components import connected
from uptake.llm.hashing import U, bit_votes, pack_bits

SHINGLE, SEED = 3, 42
#: Bytes of text fingerprinted at once; their words and hashes take about thirty times as much.
_HASHED = 1 << 20


def shingle_hashes(text: str | None) -> list[int]:
    """XXH64 of every run of three words of the text in lower case (A-Z only); of all words if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return []
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    h = xxhash.xxh64_intdigest
    return [h(joined[s:e], SEED) for s, e in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]


def fingerprints_of(texts: list[str | None]) -> np.ndarray:
    """A bit is 1 if more than half of the text's shingle hashes have it; zero without words."""
    each = [np.array(shingle_hashes(t), U) for t in texts]
    counts = np.array([len(x) for x in each], np.int64)
    if not len(each):
        return np.zeros(0, U)
    votes = bit_votes(np.concatenate(each), np.repeat(np.arange(len(each)), counts), len(each))
    return pack_bits(2 * votes > counts[:, None])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", _HASHED):
        fp = fingerprints_of(batch.column("text").to_pylist()).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("ord"), pa.array(fp)], ["row", "ord", "fp"])


_FLIPS = 1 << np.arange(32, dtype=np.uint64)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The table rows (probe false) and probes (true) of each fingerprint.

    Of two keys that differ in one bit only the one without it probes.
    """

    def key(kind: int, half: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        return (U(kind) << U(56)) | (half << U(16)) | quarter

    for batch in batches:
        all_fps = batch.column("fp").to_numpy().view(U)
        for k in range(0, len(all_fps), 20_000):
            fp = all_fps[k : k + 20_000]
            high, low = fp >> U(32), fp & U(0xFFFFFFFF)
            out: list[tuple[np.ndarray, np.ndarray, bool]] = []
            for kind, half, other in ((0, high, low), (2, low, high)):
                for sub in (0, 1):
                    own = key(kind + sub, half, (other >> U(16 * (1 - sub))) & U(0xFFFF))
                    out.append((own, fp, False))
                    out.append((own, fp, True))
                # Both halves' remainder may hold both differing bits: a ball around its first quarter.
                first = other >> U(16)
                for bit in _FLIPS[:16]:
                    at = (first & bit) == 0
                    out.append((key(kind, half[at], first[at] | bit), fp[at], True))
            for bit in _FLIPS:
                at = (high & bit) == 0
                for sub in (0, 1):
                    out.append((key(sub, high[at] | bit, (low[at] >> U(16 * (1 - sub))) & U(0xFFFF)), fp[at], True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([x[0] for x in out]).view(np.int64)),
                    pa.array(np.concatenate([x[1] for x in out]).view(np.int64)),
                    pa.array(np.repeat([x[2] for x in out], [len(x[0]) for x in out])),
                ],
                ["key", "fp", "probe"],
            )


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """``a, b``: all pairs of different values of ``fp`` that differ in at most two bits; some pairs more than once."""
    rows = fps.select("fp").mapInArrow(_index_rows, "key long, fp long, probe boolean")
    probes = rows.where("probe").select("key", F.col("fp").alias("a"))
    stored = rows.where("not probe").select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return probes.join(stored, (probes.key == stored.key) & (near <= 2) & (near > 0)).select("a", "b")


def near_components(docs: DataFrame) -> DataFrame:
    """``doc_id``, its ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest doc_id that links reach.

    Every row gets a result. Equal fingerprints are one node, whatever their number; a null or empty text
    has fingerprint zero and is linked like any other. A null ``doc_id`` counts as the
    smallest, and its component has a null id. Repeated rows are copies of each
    other. Other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.col("doc_id").alias("row"), row_order().alias("ord"), "text")
    marked = written(texts.mapInArrow(_fingerprints, f"row {id_type}, ord long, fp long"), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("ord").alias("first")), "nodes")
    groups = connected(fingerprint_links(nodes))
    roots = groups.join(nodes, F.col("node") == F.col("fp")).select("root", "fp", "first")
    least = roots.groupBy("root").agg(F.min("first").alias("least"))
    joined = roots.join(least, "root").select("fp", "least")
    of_node = nodes.join(joined, "fp", "left").select("fp", F.coalesce("least", "first").alias("component"))
    # Written, so that both sides of the next join are dealt out anew and a fingerprint with very many copies can be split.
    of_node = written(of_node, "components")
    named = F.when(F.col("component") != -(2**63), F.col("component")).cast(id_type)
    return marked.join(of_node, "fp").select(
        F.col("row").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), named.alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """All columns of one row of each component: that with the smallest ``doc_id``, nulls first, then with the smallest hash.

    Components that share that id keep a row each. Null and empty texts are one component, repeated
    rows keep one; columns may have any name; an empty table gives an empty result.
    """
    marked = numbered(docs)
    texts = marked.select(F.col("uid").alias("row"), row_order("whole.doc_id").alias("ord"), F.col("whole.text").alias("text"))
    fps = written(texts.mapInArrow(_fingerprints, "row long, ord long, fp long"), "fingerprints")
    groups = connected(fingerprint_links(fps.select("fp").distinct())).withColumnRenamed("node", "fp")
    hashes = marked.select(F.col("uid").alias("row"), F.xxhash64("whole").alias("hash"))
    of_row = fps.join(groups, "fp", "left").withColumn("group", F.coalesce("root", "fp")).join(hashes, "row")
    chosen = of_row.groupBy("group").agg(F.min(F.struct("ord", "hash", "row")).alias("first")).select(F.col("first.row").alias("uid"))
    return marked.join(chosen, "uid", "left_semi").select("whole.*")
