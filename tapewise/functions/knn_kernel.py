"""Per-task k-nearest-neighbour kernel used by ``models.knn_classify``.

This module is pickled by value into the Python workers, so executors do not
need the package installed.  It only depends on numpy and pandas.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

EMPTY_COLUMNS = {"qid": "int64", "tid": "int64", "dist": "float64", "label": "int32"}


def local_topk(q: pd.DataFrame, t: pd.DataFrame, k: int) -> pd.DataFrame:
    """k smallest squared Euclidean distances per query row of one (query block, train block) pair.

    Distances are exact in float64; ties at the k-th distance are resolved by
    the smaller train key.
    """
    if q.empty or t.empty:
        return pd.DataFrame({c: pd.Series(dtype=d) for c, d in EMPTY_COLUMNS.items()})
    qv = np.stack(q["vec"].to_numpy()).astype(np.float64)
    tv = np.stack(t["vec"].to_numpy()).astype(np.float64)
    tid = t["tid"].to_numpy()
    tlab = t["label"].to_numpy()
    qids = q["qid"].to_numpy()
    out_q, out_t, out_d, out_l = [], [], [], []
    finite = bool(np.isfinite(qv).all() and np.isfinite(tv).all())
    qn, tn = (np.einsum("ik,ik->i", v, v) for v in (qv, tv))
    slack = 32 * (tv.shape[1] + 8) * np.finfo(np.float64).eps
    step = max(1, int(4_000_000 // max(1, tv.shape[0]))) if finite else max(1, int(2_000_000 // max(1, tv.shape[0] * tv.shape[1])))
    kk = min(k, tv.shape[0])
    for s in range(0, qv.shape[0], step):
        part = qv[s:s + step]
        if finite:
            # expanded squares pick the rows that can be among the nearest; their distances are then computed as differences
            near = qn[s:s + step, None] + tn[None, :] - 2 * (part @ tv.T)
            kth = np.partition(near, kk - 1, axis=1)[:, kk - 1]
            row, at = np.nonzero(near <= (kth + slack * (qn[s:s + step] + tn.max()))[:, None])
            dist = np.empty(len(row))
            most = max(1, 2_000_000 // max(1, tv.shape[1]))
            for i in range(0, len(row), most):
                diff = part[row[i:i + most]] - tv[at[i:i + most]]
                dist[i:i + most] = np.einsum("ijk,ijk->ij", diff[None], diff[None])[0]
        else:
            diff = part[:, None, :] - tv[None, :, :]
            every = np.einsum("ijk,ijk->ij", diff, diff)
            kth = np.partition(every, kk - 1, axis=1)[:, kk - 1]
            row, at = np.nonzero(every <= kth[:, None])
            dist = every[row, at]
        by = np.lexsort((tid[at], dist, row))
        row, at, dist = row[by], at[by], dist[by]
        first = np.searchsorted(row, row, side="left")
        keep = np.arange(len(row)) - first < kk
        out_q.extend(qids[s + row[keep]].tolist())
        out_t.extend(tid[at[keep]].tolist())
        out_d.extend(dist[keep].tolist())
        out_l.extend(tlab[at[keep]].tolist())
    return pd.DataFrame({"qid": np.array(out_q, dtype="int64"), "tid": np.array(out_t, dtype="int64"),
                         "dist": np.array(out_d, dtype="float64"), "label": np.array(out_l, dtype="int32")})
