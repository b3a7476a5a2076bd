"""Ranked lexical search over a length-stratified index: postings by tf within documents of equal normaliser."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilgrid.llm.arrow import map_texts
from perilgrid.llm.shipping import ship_package
from perilgrid.session import drop_dir, new_dir

TOP = 20
# Queries are searched in batches of about this many bytes of text; what is sent to all tasks is a batch.
BATCH_BYTES = 4 << 20
# Postings of the documents that a task holds at once; strata are cut there.
BLOCK_POSTINGS = 1 << 21
BLOCK_DOCS = 1 << 15
_NO_ID = (1 << 63) - 1  # stands for a null doc_id: after all others among equal scores

# Everything in ASCII that is not a letter or digit separates terms; A-Z are lower-cased.
_FOLD = bytes(
    b if chr(b).isalnum() and b < 128 and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else b if b > 127 else 32
    for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in their order, with repeats."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _forward(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term array, tf array) of every row; terms are those that a query of the batch holds."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def rows(doc_id: list, text: list[str]) -> dict:
        known, out = shared.value, {"doc_id": doc_id, "n": [], "term": [], "tf": []}
        for t in text:
            found = terms(t)
            counts = Counter(map(known.get, found))
            counts.pop(None, None)
            out["n"].append(len(found))
            out["term"].append(list(counts))
            out["tf"].append(list(counts.values()))
        return out

    return map_texts(docs.select("doc_id", "text"), "doc_id long, n long, term array<long>, tf array<long>", rows)


class _Batch:
    """Queries as term numbers and weights, one after the other."""

    def __init__(self, queries: list[list[int]], weights: np.ndarray):
        self.starts = np.cumsum([0, *map(len, queries)])
        self.terms = np.array([t for q in queries for t in sorted(q)], np.int64)
        self.weights = weights[self.terms] if len(self.terms) else np.empty(0, np.int64)
        self.size = len(weights)

    def bounds(self, best: np.ndarray) -> np.ndarray:
        """Highest score that any document can have, from the highest impact of each term."""
        sums = np.concatenate([[0], np.cumsum(self.weights * best[self.terms])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]


class Stratum:
    """Postings of documents with one normaliser ``m``, sorted by term and tf."""

    def __init__(self, m: int, ids: np.ndarray, term: np.ndarray, tf: np.ndarray, doc: np.ndarray, n_terms: int):
        order = np.lexsort((doc, tf, term))
        self.ids, self.term, self.doc = ids, term[order], doc[order]
        levels, level_of = np.unique(tf[order], return_inverse=True)
        # one impact for each tf of the stratum
        self.impact = (1_000_000_000 * levels) // (1000 * levels + 12 * m)
        self.scores = self.impact[level_of]
        self.starts = np.searchsorted(self.term, np.arange(n_terms + 1))
        # impacts rise with tf, so the last posting of a term has its highest
        last = self.starts[1:] - 1
        self.best = np.where(self.starts[1:] > self.starts[:-1], self.scores[last], 0) if len(self.term) else np.zeros(n_terms, np.int64)

    def score(self, batch: _Batch, q: int) -> np.ndarray:
        """Scores of all documents of the stratum for one query."""
        total = np.zeros(len(self.ids), np.int64)
        for k in range(batch.starts[q], batch.starts[q + 1]):
            part = slice(self.starts[t := batch.terms[k]], self.starts[t + 1])
            total[self.doc[part]] += batch.weights[k] * self.scores[part]
        return total


class _Top:
    """Best documents of each query so far."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.score = [np.empty(0, np.int64)] * n_queries
        self.ids = [np.empty(0, np.int64)] * n_queries
        self.least = np.ones(n_queries, np.int64)  # scores below do not enter

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        enter = scores >= self.least[q]
        scores, ids = np.concatenate([self.score[q], scores[enter]]), np.concatenate([self.ids[q], ids[enter]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.score[q], self.ids[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[q] = max(1, self.score[q][-1])


def _visit(strata: list[Stratum], batch: _Batch, top: _Top) -> None:
    """Search strata, for each query those of the highest bound first; the others end at the k-th score."""
    if not strata:
        return
    bounds = np.stack([batch.bounds(s.best) for s in strata])
    for q in np.nonzero((bounds >= top.least).any(axis=0))[0].tolist():
        for s in np.argsort(-bounds[:, q], kind="stable").tolist():
            if bounds[s, q] < top.least[q]:
                break
            top.add(q, strata[s].score(batch, q), strata[s].ids)


def _strata(held: list[pa.RecordBatch], n_terms: int) -> list[Stratum]:
    """Strata of rows that are sorted by m."""
    table = pa.Table.from_batches(held).combine_chunks()
    m, ids = table["m"].to_numpy(), table["doc_id"].to_numpy()
    lists = table["term"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    term, tf = lists.flatten().to_numpy(), table["tf"].combine_chunks().flatten().to_numpy()
    cuts = [0, *(np.nonzero(m[1:] != m[:-1])[0] + 1).tolist(), len(m)]
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        doc = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
        out.append(Stratum(int(m[a]), ids[a:b], term[ends[a] : ends[b]], tf[ends[a] : ends[b]], doc, n_terms))
    return out


def _search(index: DataFrame, batch: _Batch, k: int) -> DataFrame:
    """(query, score, doc_id): the ``k`` best rows of each task of the index."""
    shared = index.sparkSession.sparkContext.broadcast(batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        top = _Top(len(queries.starts) - 1, k)
        held, postings, docs = [], 0, 0
        for part in batches:
            held.append(part)
            postings += len(part.column("term").flatten())
            docs += part.num_rows
            if postings >= BLOCK_POSTINGS or docs >= BLOCK_DOCS:
                _visit(_strata(held, queries.size), queries, top)
                held, postings, docs = [], 0, 0
        if held:
            _visit(_strata(held, queries.size), queries, top)
        found = [np.full(len(s), q) for q, s in enumerate(top.score)]
        columns = [np.concatenate([np.empty(0, np.int64), *c]) for c in (found, top.score, top.ids)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "score", "doc_id"])

    return index.mapInArrow(run, "query long, score long, doc_id long")


def build_index(docs: DataFrame, numbers: dict[bytes, int]) -> tuple[DataFrame, int, dict[int, int], str]:
    """The index of a batch's terms, dealt by normaliser, with N and the document frequencies.

    Each row is a document (doc_id, m, term, tf); a task holds whole strata or parts of them, sorted by m.
    """
    spark = docs.sparkSession
    path = new_dir(spark, "search-forward")
    _forward(docs, numbers).write.parquet(path)
    rows = spark.read.parquet(path)
    n_docs, total = rows.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    df = rows.select(F.explode("term").alias("term")).groupBy("term").count().collect()  # terms of one batch at most
    m = f"75 + (25 * n * {n_docs}L) div {total or 1}L"
    held = rows.where("size(term) > 0").withColumn("m", F.expr(m))
    held = held.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), "m", "term", "tf")
    # a frequent m spreads over tasks by document
    index = held.repartitionByRange("m", F.xxhash64("doc_id", "term")).sortWithinPartitions("m")
    return index, n_docs, {r["term"]: r["count"] for r in df}, path


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every query row.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case. With N documents of at least
    one term, L terms in all, n terms of a document and df documents that hold a term, the term weighs
    w = floor(1000 ln((2N+2)/(2df+1))), a document's normaliser is m = 75 + (25 n N) div L, and its score sums
    w * ((10^9 tf) div (1000 tf + 12 m)) over the terms of the query, repeats included. Only scores above zero
    are ranked, equal ones by doc_id.

    Documents of equal m are a stratum: a term has one impact for each tf there, and the highest gives a bound for
    each query, which orders the visits and ends them at the k-th score found. The index holds every document,
    with the terms that the queries hold; queries are searched in batches by hash so that a batch has a bounded
    size. Each task keeps k rows for each query, which are merged by rank.

    Null and empty texts have no terms: such documents and queries are in no result. Rows that share a doc_id are
    ranked each; a null doc_id stands last among equal scores. Rows that share an item_id are separate queries
    with the same results; a null item_id is returned as such. Empty tables give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    size = queries.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    n_batches = int(size // BATCH_BYTES) + 1
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_batches))
    out = None
    for b in range(n_batches):
        given = queries.select("item_id", "text").where(number == b).collect()
        given = [(r.item_id, terms(r.text)) for r in given]
        numbers = {t: i for i, t in enumerate(sorted({t for _, q in given for t in q}))}
        index, n_docs, df, path = build_index(docs, numbers)
        weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(numbers))], np.int64)
        batch = _Batch([[numbers[t] for t in q] for _, q in given], weights)
        found = _search(index, batch, k)
        ranked = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(given)], f"query long, item_id {queries.schema['item_id'].dataType.simpleString()}")
        best = best.join(F.broadcast(ids), "query").withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))
        stored = new_dir(spark, "search-results")
        best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score").write.parquet(stored)
        drop_dir(spark, path)
        best = spark.read.parquet(stored)
        out = best if out is None else out.union(best)
    return out
