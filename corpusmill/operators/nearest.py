"""Exact nearest neighbours by cosine: a query set in blocks against all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import ship, written

#: Query vectors, and rows, that a task holds at once.
BLOCK, CHUNK = 4096, 65_536


def chunks(batches: Iterator[pd.DataFrame], size: int = CHUNK) -> Iterator[pd.DataFrame]:
    """The same rows in frames of at least ``size`` rows, but for the last."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if len(b):
            held.append(b)
        if sum(map(len, held)) >= size:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def nearest(queries: DataFrame, rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(query_id, nearest_id, sim)``: the row of greatest cosine other than the query itself; ties go to the smaller id.

    Queries are written once; every task reads them block by block and multiplies each with its own rows, so neither side
    is broadcast or held whole. A task hands on one best row per query, and these meet in one aggregation.
    Null vectors and vectors of length 0 have a cosine of 0 with all others; vectors of unlike length are an error.
    """
    ship(rows.sparkSession)
    pick = lambda df: df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v"))
    path = written(pick(queries), "nearest-queries").inputFiles()

    def unit(m: np.ndarray) -> np.ndarray:
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.dataset as ds

        best: dict[int, tuple[float, int]] = {}
        # A task's rows come together first: the queries are read once for each group of CHUNK rows, not for each batch.
        for b in chunks(batches):
            ids = b["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, m = ids[order], unit(np.stack(b["v"].to_numpy()[order]).astype(np.float64))
            files = [p.removeprefix("file://").removeprefix("file:") for p in path]
            for q in ds.dataset(files, format="parquet").to_batches(batch_size=BLOCK):
                if not q.num_rows:
                    continue
                qid = q.column("id").to_numpy()
                s = unit(np.array(q.column("v").to_pylist(), np.float64)) @ m.T
                s[qid[:, None] == ids[None, :]] = -np.inf
                at = s.argmax(1)
                for i, k in enumerate(at):
                    v = (float(s[i, k]), -int(ids[k]))
                    if v[0] > -np.inf and v > best.get(int(qid[i]), (-np.inf, 0)):
                        best[int(qid[i])] = v
        if best:
            yield pd.DataFrame({"query_id": list(best), "nearest_id": [-v[1] for v in best.values()], "sim": [v[0] for v in best.values()]})

    found = pick(rows).mapInPandas(run, "query_id bigint, nearest_id bigint, sim double")
    top = found.groupBy("query_id").agg(F.max(F.struct("sim", (-F.col("nearest_id")).alias("n"))).alias("b"))
    return top.select("query_id", (-F.col("b.n")).alias("nearest_id"), "b.sim")
