"""NumPy kernels that run *inside* Spark tasks on Arrow batches.

They never see a whole table: each call gets one Arrow batch (or one
bounded group) and the broadcast query block.  Scores are float64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Max number of float64 cells of one (rows x queries) score block: 32 MiB.
SCORE_BLOCK_CELLS = 1 << 22


def arrow_vectors(arr: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a non-NULL vector and their ``(n, dim)`` float64 matrix.

    A vector whose length differs from ``dim`` is a data error and raises.
    NULL elements inside a vector become NaN (their scores are dropped).
    """
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    valid = np.asarray(arr.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
    rows = np.nonzero(valid)[0]
    if len(rows) == 0:
        return rows, np.zeros((0, dim))
    lengths = np.asarray(arr.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    bad = valid & (lengths != dim)
    if bad.any():
        raise ValueError(f"vector of dimension {int(lengths[bad][0])} in a table of dimension {dim}")
    values = arr.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return rows, flat.reshape(-1, dim)


def pandas_vectors(series, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Same as :func:`arrow_vectors` for a pandas column of arrays."""
    valid = series.notna().to_numpy()
    rows = np.nonzero(valid)[0]
    if len(rows) == 0:
        return rows, np.zeros((0, dim))
    mats = [np.asarray(v, dtype=np.float64) for v in series.to_numpy()[rows]]
    for m in mats:
        if m.shape[0] != dim:
            raise ValueError(f"vector of dimension {m.shape[0]} in a table of dimension {dim}")
    return rows, np.vstack(mats)


def scores(metric: str, X: np.ndarray, Q: np.ndarray) -> np.ndarray:
    """``(n, m)`` scores of rows X against queries Q (NaN = no score)."""
    ip = X @ Q.T
    if metric == "IP":
        return ip
    xn = np.einsum("ij,ij->i", X, X)
    qn = np.einsum("ij,ij->i", Q, Q)
    if metric == "L2":
        return np.maximum(xn[:, None] + qn[None, :] - 2.0 * ip, 0.0)
    denom = np.sqrt(xn[:, None] * qn[None, :])
    with np.errstate(divide="ignore", invalid="ignore"):
        out = ip / denom
    out[denom == 0] = np.nan
    return out


def pair_scores(metric: str, X: np.ndarray, Q: np.ndarray) -> np.ndarray:
    """Row-wise scores of matched pairs ``(X[i], Q[i])`` (NaN = no score)."""
    ip = np.einsum("ij,ij->i", X, Q)
    if metric == "IP":
        return ip
    if metric == "L2":
        d = X - Q
        return np.einsum("ij,ij->i", d, d)
    denom = np.sqrt(np.einsum("ij,ij->i", X, X) * np.einsum("ij,ij->i", Q, Q))
    with np.errstate(divide="ignore", invalid="ignore"):
        out = ip / denom
    out[denom == 0] = np.nan
    return out


def to_key(s: np.ndarray, higher_better: bool) -> np.ndarray:
    """Smaller key = better; NaN stays NaN."""
    return -s if higher_better else s


def candidate_pairs(key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, query) pairs among the k best keys of each column, ties kept.

    NaN keys are never selected.  At most ``k`` + ties rows per column.
    """
    n, m = key.shape
    finite = ~np.isnan(key)
    if n <= k:
        r, q = np.nonzero(finite)
        return r, q
    kth = np.partition(np.where(finite, key, np.inf), k - 1, axis=0)[k - 1]
    mask = finite & (key <= kth[None, :])
    r, q = np.nonzero(mask)
    return r, q


def select_topk(group: np.ndarray, key: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best ``(key, tie)`` per group; rows equal to the k-th are kept."""
    if len(group) == 0:
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort((tie, key, group))
    g = group[order]
    kk = key[order]
    tt = tie[order]
    starts = np.r_[0, np.nonzero(g[1:] != g[:-1])[0] + 1]
    first = np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    pos = np.arange(len(g)) - first
    keep = pos < k
    # rows tied with the k-th on (key, tie) stay: the final ordering decides
    last_idx = np.minimum(first + k - 1, np.repeat(np.r_[starts[1:], len(g)], np.diff(np.r_[starts, len(g)])) - 1)
    tied = (kk == kk[last_idx]) & (tt == tt[last_idx])
    return order[keep | tied]


def block_size(n_rows: int, n_queries: int) -> int:
    """Queries per scoring block so one block stays within SCORE_BLOCK_CELLS."""
    return max(1, min(n_queries, SCORE_BLOCK_CELLS // max(1, n_rows)))


def partition_mask(row_values, query_parts):
    """``allow(j0, j1) -> (rows, j1 - j0)`` booleans: may query j see row i?

    ``query_parts[j]`` is None (all partitions) or a set of names."""
    if query_parts is None:
        return None
    coded = pa.array(row_values).dictionary_encode(null_encoding="encode") if not isinstance(row_values, pa.Array) \
        else row_values.dictionary_encode(null_encoding="encode")
    uniq = coded.dictionary.to_pylist()
    vidx = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    masks = np.array([[p is None or v in p for p in query_parts] for v in uniq], dtype=bool).reshape(len(uniq), -1)
    return lambda j0, j1: masks[vidx, j0:j1]


# Matched pairs re-scored at a time (floats of one side).
PAIR_CELLS = 1 << 22


def paired(metric: str, X: np.ndarray, Q: np.ndarray, r: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``pair_scores(X[r], Q[q])`` in bounded pieces."""
    step = max(1, PAIR_CELLS // max(1, X.shape[1]))
    if len(r) <= step:
        return pair_scores(metric, X[r], Q[q])
    return np.concatenate([pair_scores(metric, X[r[i:i + step]], Q[q[i:i + step]]) for i in range(0, len(r), step)])


def _prefiltered(metric: str, higher: bool, X: np.ndarray, Q: np.ndarray, k: int, allow_blk, precision: str):
    """A matrix product, then every row whose error bound reaches the exact top k
    re-scored pair by pair in float64.  Returns ``(rows, queries, exact scores)`` -
    a proven superset of the exact top k per query, no cap.

    L2 is shift-invariant, so rows and queries are centred first: the product of
    vectors far from the origin would cancel."""
    d = X.shape[1]
    unit = 2.0 ** -23 if precision == "float32" else 2.0 ** -52
    c = (d + 4) * unit  # |product - ip| <= c |x| |q|
    A, B = X, Q
    if metric == "L2":
        centre = np.where(np.isfinite(Q), Q, 0.0).mean(axis=0)
        A, B = X - centre, Q - centre
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        xn = np.sqrt(np.einsum("ij,ij->i", A, A))
        qn = np.sqrt(np.einsum("ij,ij->i", B, B))
        if precision == "float32":
            ip = (A.astype(np.float32) @ B.astype(np.float32).T).astype(np.float64)
        else:
            ip = A @ B.T
        size = xn[:, None] * qn[None, :]
        if metric == "IP":
            approx, err = ip, c * size
        elif metric == "L2":
            squares = xn[:, None] ** 2 + qn[None, :] ** 2
            approx, err = squares - 2.0 * ip, 2.0 * c * size + 2.0 * (d + 4) * 2.0 ** -52 * squares
        else:
            approx, err = ip / size, np.full_like(ip, c + 4.0 * (d + 4) * 2.0 ** -52)
        key = to_key(approx, higher)
        # no score: a NaN or infinite input, or a zero vector under COSINE
        usable = (np.isfinite(X).all(axis=1)[:, None] & np.isfinite(Q).all(axis=1)[None, :])
        if metric == "COSINE":
            usable &= size > 0
        if allow_blk is not None:
            usable &= allow_blk
        known = np.isfinite(key) & np.isfinite(err)  # else the product overflowed: such a pair is always re-scored
        low = np.where(usable, np.where(known, key - err, -np.inf), np.nan)
        high = np.where(usable, np.where(known, key + err, np.inf), np.inf)
    if key.shape[0] <= k:
        r, q = np.nonzero(usable)
    else:
        kth = np.partition(high, k - 1, axis=0)[k - 1]  # the k-th best is at least this good
        r, q = np.nonzero(usable & (low <= kth[None, :]))
    return r, q, paired(metric, X, Q, r, q)


def local_topk(metric: str, higher: bool, X: np.ndarray, ids: np.ndarray, Q: np.ndarray, k: int, allow=None,
               precision: str = "float64"):
    """Best k rows for each query over one block of rows.

    ``allow``: optional :func:`partition_mask` result restricting which rows
    each query may see.  ``precision="float32"`` runs the product in float32
    and re-scores the survivors exactly (same result, about half the
    product time); L2 always re-scores survivors, by differences.  Returns ``(row_index, query_index, score)`` arrays.
    """
    rs, qs, ss = [], [], []
    bounded = precision == "float32" or metric == "L2"  # several tables of a block's size stand side by side
    step = max(1, block_size(X.shape[0], Q.shape[0]) // (8 if bounded or allow is not None else 1))
    for j0 in range(0, Q.shape[0], step):
        if bounded:
            blk = allow(j0, min(j0 + step, Q.shape[0])) if allow is not None else None
            r, q, sc = _prefiltered(metric, higher, X, Q[j0:j0 + step], k, blk, precision)
            ex_key = to_key(sc, higher)
            ok = ~np.isnan(ex_key)
            r, q, sc, ex_key = r[ok], q[ok], sc[ok], ex_key[ok]
            if len(r) > 0:
                sel = select_topk(q, ex_key, ids[r], k)
                rs.append(r[sel])
                qs.append(q[sel] + j0)
                ss.append(sc[sel])
            continue
        s = scores(metric, X, Q[j0:j0 + step])
        key = to_key(s, higher)
        if allow is not None:
            key = np.where(allow(j0, j0 + s.shape[1]), key, np.nan)
        r, q = candidate_pairs(key, k)
        if len(r) > 0:
            sel = select_topk(q, key[r, q], ids[r], k)
            r, q = r[sel], q[sel]
            rs.append(r)
            qs.append(q + j0)
            ss.append(s[r, q])
    if not rs:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(0)
    return np.concatenate(rs), np.concatenate(qs), np.concatenate(ss)


def coded_bounds(metric: str, codes: np.ndarray, err: np.ndarray, lo: np.ndarray, step: np.ndarray, Q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(low, high)`` keys (smaller is better) between which the exact score of every (row, query) pair lies.

    ``codes`` (uint8) decode to ``lo + codes * step``, at most ``err`` (Euclidean) from the row.  The product runs on
    the codes themselves in float32, where they are whole numbers; its rounding is part of the bounds."""
    d = codes.shape[1]
    c32, c64 = (d + 4) * 2.0 ** -23, (d + 4) * 2.0 ** -52
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        A = codes.astype(np.float32)
        weights = Q * step
        base = Q @ lo
        qn = np.sqrt(np.einsum("ij,ij->i", Q, Q))
        size = np.sqrt(np.einsum("ij,ij->i", A, A).astype(np.float64))
        ip = (A @ weights.astype(np.float32).T).astype(np.float64) + base[None, :]
        slack = 2 * c32 * size[:, None] * np.sqrt(np.einsum("ij,ij->i", weights, weights))[None, :]
        slack += c64 * (np.abs(base) + qn * float(np.sqrt(lo @ lo)))[None, :] + c64 * np.abs(ip)
        e = err[:, None].astype(np.float64)
        if metric == "IP":
            off = qn[None, :] * e * (1 + c64) + slack
            low, high = -(ip + off), -(ip - off)
        else:
            D = lo + codes * step
            xn = np.sqrt(np.einsum("ij,ij->i", D, D))[:, None]
            if metric == "L2":
                square = xn ** 2 + qn[None, :] ** 2 - 2.0 * ip
                off = 2 * slack + 4 * c64 * (xn ** 2 + qn[None, :] ** 2)
                low = np.maximum(np.sqrt(np.maximum(square - off, 0)) - e, 0) ** 2 * (1 - 8 * c64)
                high = (np.sqrt(np.maximum(square + off, 0)) + e) ** 2 * (1 + 8 * c64)
            else:
                off = qn[None, :] * e + slack
                near, far = (xn - e) * (1 - 4 * c64), (xn + e) * (1 + 4 * c64)
                ends = [(ip + s * off) / (qn[None, :] * n) for s in (1, -1) for n in (near, far)]
                low = np.where(near > 0, -np.maximum(ends[0], ends[1]) - 4 * c64, -np.inf)
                high = np.where(near > 0, -np.minimum(ends[2], ends[3]) + 4 * c64, np.inf)
        low = np.where(np.isnan(low), -np.inf, low)  # nothing is known of such a pair: it is always scored
        high = np.where(np.isnan(high), np.inf, high)
    return low, high


def coded_topk(metric: str, higher: bool, codes: np.ndarray, err: np.ndarray, lo: np.ndarray, step: np.ndarray, X: np.ndarray,
               ids: np.ndarray, Q: np.ndarray, k: int, allow=None):
    """:func:`local_topk` that reads vectors of those rows only whose bounds reach the k best: a proven superset, no cap.
    Also returns how many pairs were scored exactly."""
    rs, qs, ss, scored = [], [], [], 0
    size = max(1, block_size(codes.shape[0], Q.shape[0]) // 8)  # several tables of this size stand side by side
    for j0 in range(0, Q.shape[0], size):
        part = Q[j0:j0 + size]
        low, high = coded_bounds(metric, codes, err, lo, step, part)
        seen = np.ones(low.shape, bool) if allow is None else allow(j0, j0 + len(part))
        if len(codes) <= k:
            r, q = np.nonzero(seen)
        else:
            kth = np.partition(np.where(seen, high, np.inf), k - 1, axis=0)[k - 1]
            r, q = np.nonzero(seen & (low <= kth[None, :]))
        scored += len(r)
        key = to_key(paired(metric, X, part, r, q), higher)
        ok = ~np.isnan(key)
        if not ok.all() and len(codes) > k:  # rows without a score must not have pushed others out
            r, q = np.nonzero(seen)
            scored += len(r) - len(ok)
            key = to_key(paired(metric, X, part, r, q), higher)
            ok = ~np.isnan(key)
        r, q, key = r[ok], q[ok], key[ok]
        sel = select_topk(q, key, ids[r], k)
        rs.append(r[sel])
        qs.append(q[sel] + j0)
        ss.append(to_key(key[sel], higher))
    if not rs:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(0), 0
    return np.concatenate(rs), np.concatenate(qs), np.concatenate(ss), scored
