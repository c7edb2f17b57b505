"""Text repeated across the documents of one source.

Normalised text is cut by content: a rolling hash over the last letters ends a chunk wherever its low
bits are zero, whatever the line breaks are. Documents are counted per source and chunk. A line is a
candidate if every chunk that lies inside it is repeated; two equal lines always hold equal inner
chunks, so no repeated line is lost, while most other lines go before anything about them is moved.
Candidates are then counted exactly, by distinct document. What is repeated is bounded for each source
(at most ``1/share`` times the lines of a document), so it travels as one array per source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

#: Letters the rolling hash looks back on, and low bits that must be zero (a chunk in 16 letters).
WINDOW, BITS = 12, 4
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
#: Letters handled at once; bounds the memory of a batch of very long texts.
_BLOCK = 1 << 20


def plain_lines(text: Column) -> Column:
    """Lower case, every run of other characters than a-z and line breaks one space."""
    return F.regexp_replace(F.lower(text), r"[^a-z\n]+", " ")


def line_keys(text: Column, least_words: int) -> Column:
    """The distinct keys of a text's lines with at least so many words."""
    keys = F.transform(F.split(plain_lines(text), "\n"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(keys, lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) >= least_words - 1))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def chunks(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the chunks between content-defined boundaries of ``letters``.

    The stretch before the first boundary and after the last is no chunk, as its other end does not
    depend on content alone.
    """
    n = len(letters)
    if n <= WINDOW:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
        inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
        at = np.arange(WINDOW, n + 1)
        rolling = _mix((sums[at] - sums[at - WINDOW]) * inverse[at - WINDOW])
        ends = at[(rolling & np.uint64((1 << BITS) - 1)) == 0]
        starts, ends = ends[:-1], ends[1:]
        return starts, ends, _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _BLOCK:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def _laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts one after the other, line breaks as blanks, and where each text starts."""
    raw = "\n".join(texts).encode("ascii", "replace")
    letters = np.frombuffer(raw, dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return np.where(letters == 10, 32, letters).astype(np.uint8), starts


def _count_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in _blocks(texts):
            letters, begins = _laid_out(texts[a:b])
            starts, ends, hashes = chunks(letters)
            doc = np.searchsorted(begins, starts, side="right") - 1
            inside = ends < begins[doc + 1]
            found = pd.DataFrame({"doc": doc[inside], "chunk": hashes[inside].astype(np.int64)}).drop_duplicates()
            found["source"] = batch["source"].to_numpy()[a:b][found["doc"]]
            yield found.groupby(["source", "chunk"], as_index=False, sort=False).size().rename(columns={"size": "n"})


def _candidate_lines(least_words: int):  # noqa: ANN202
    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, known = batch["text"].tolist(), batch["chunks"].tolist()
            known = [np.sort(np.asarray(k, dtype=np.int64)) if k is not None else np.zeros(0, np.int64) for k in known]
            for a, b in _blocks(texts):
                letters, begins = _laid_out(texts[a:b])
                starts, ends, hashes = chunks(letters)
                hashes = hashes.astype(np.int64)
                doc = np.searchsorted(begins, starts, side="right") - 1
                common = np.zeros(len(starts), dtype=bool)
                for d in np.unique(doc):
                    rows = slice(np.searchsorted(doc, d), np.searchsorted(doc, d, side="right"))
                    mine = known[a + d]
                    if len(mine):
                        common[rows] = mine[np.minimum(np.searchsorted(mine, hashes[rows]), len(mine) - 1)] == hashes[rows]
                rare = np.concatenate([[0], np.cumsum(~common)])
                keep: list[list[str]] = []
                for i, text in enumerate(texts[a:b]):
                    keys, at = [], int(begins[i])
                    for line in text.split("\n"):
                        end = at + len(line)
                        key = line.strip()
                        if key.count(" ") >= least_words - 1:
                            # chunks with both boundary windows within the line's own letters
                            first = at + len(line) - len(line.lstrip())
                            i0 = np.searchsorted(starts, first + WINDOW)
                            i1 = np.searchsorted(ends, end - (len(line) - len(line.rstrip())), side="right")
                            if i1 <= i0 or rare[i1] == rare[i0]:
                                keys.append(key)
                        at = end + 1
                    keep.append(list(dict.fromkeys(keys)))
                out = batch.iloc[a:b][["doc", "source"]].copy()
                out["keys"] = keep
                yield out[out["keys"].map(len) > 0]

    return candidates


def repeated_lines(
    docs: DataFrame, doc: str, source: str, text: str, least_docs: int = 5, share: float = 0.1, least_words: int = 5, broadcast_chunks: int = 2_000_000
) -> tuple[DataFrame, DataFrame]:
    """Lines repeated excessively within a source.

    Returns ``(doc, source, keys)``, the candidate lines of each document, and ``(source, repeated)``,
    the keys of each source that at least ``least_docs`` documents and at least ``share`` of all its
    documents hold (distinct documents; those with a null or empty text count). Documents without a
    source or without a key are left out. A document given twice counts once; lines repeated within one count once.

    The chunk table is broadcast only while it has at most ``broadcast_chunks`` entries (8 bytes each);
    beyond that it is joined by source, where AQE splits a hot source.
    """
    rows = docs.select(F.col(doc).alias("doc"), F.col(source).alias("source"), F.col(text).alias("text")).where("source is not null and doc is not null")
    totals = rows.select("doc", "source").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("docs"))
    totals = totals.select("source", F.greatest(F.lit(least_docs), F.ceil(F.col("docs") * share - 1e-9)).alias("least"))
    texts = rows.where("text is not null").select("doc", "source", plain_lines(F.col("text")).alias("text"))

    counted = texts.select("source", "text").mapInPandas(_count_chunks, "source string, chunk bigint, n bigint")
    counted = counted.groupBy("source", "chunk").agg(F.sum("n").alias("n"))
    # rows of a document given twice count twice here, which only lets more lines through to the exact count
    common = cut(counted.join(totals, "source").where("n >= least").groupBy("source").agg(F.collect_list("chunk").alias("chunks")))
    entries = common.agg(F.sum(F.size("chunks"))).first()[0] or 0
    joined = texts.join(F.broadcast(common) if entries <= broadcast_chunks else common, "source", "left")
    candidates = cut(joined.mapInPandas(_candidate_lines(least_words), f"doc {rows.schema['doc'].dataType.simpleString()}, source string, keys array<string>"))

    hashed = candidates.select("doc", "source", F.explode("keys").alias("key")).select("doc", "source", F.xxhash64("key").alias("line"))
    lines = hashed.distinct().groupBy("source", "line").agg(F.count(F.lit(1)).alias("n"))
    repeated = lines.join(totals, "source").where("n >= least").groupBy("source").agg(F.collect_list("line").alias("repeated"))
    return candidates, cut(repeated)


def with_repeated(docs: DataFrame, repeated: DataFrame, source: str, broadcast_lines: int = 2_000_000) -> DataFrame:
    """``docs`` with ``repeated``, the line hashes of its source (null where it has none)."""
    entries = repeated.agg(F.sum(F.size("repeated"))).first()[0] or 0
    side = repeated.withColumnRenamed("source", "_source")
    side = F.broadcast(side) if entries <= broadcast_lines else side
    docs = docs.drop("repeated")
    return docs.join(side, docs[source] == side["_source"], "left").drop("_source")


def cut_lines(text: Column, repeated: Column) -> Column:
    """``text`` without its lines whose key is in ``repeated``; all other lines unchanged."""
    def stays(line: Column) -> Column:
        key = F.trim(F.regexp_replace(F.lower(line), r"[^a-z]+", " "))
        return ~F.array_contains(repeated, F.xxhash64(key))

    return F.when(repeated.isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n"), stays), "\n"))
