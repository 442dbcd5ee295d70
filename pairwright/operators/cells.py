"""What one Python call computes in one cell. Spark decides which rows meet; these only do the arithmetic."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pairwright.settings import RetrievalSettings

_SLAB = 1_048_576  # scores computed at once
_PRODUCT = 4_194_304  # estimates computed at once
_NEAR = 524_288  # scores looked at at once, so that they stay in a core's cache
_FOLD = 32  # scores told apart by their maximum
_FOLDS = 640
_COLUMNS = 1_024
_SCALE = float(1 << 40)
_FEW = 16  # one score in so many may be computed by itself
_GATHER = 1_024
_WIDEST = 65_536  # the error bound holds far beyond; vectors are never that wide
_STEP = 40  # vector elements are counted in steps of 2^-40 where moments are summed
_LIMB = 20
_FARTHEST = 8.0  # scores beyond are not those of vectors of about unit norm
_SUMMABLE = float(1 << 53)  # whole numbers up to here add up exactly in double
_SUM_BYTES = 48
_MOMENTS_WIDTH = 512  # second moments of wider vectors are not kept


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("embedding").combine_chunks()
    lengths = pc.unique(pc.list_value_length(column)).to_pylist()
    if len(lengths) > 1 or None in lengths:
        raise ValueError(f"vectors must have one common length, found {lengths}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scores(targets: np.ndarray, columns: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Slabs (first row, scores). Products of floats are exact in double and are summed in element order, so equal
    vectors get equal scores wherever they stand; a library matrix product would not promise that."""
    n = columns.shape[1]
    wide = columns if n > 1 else np.repeat(columns, 2, axis=1)
    step = max(1, _SLAB // n)
    for row in range(0, len(targets), step):
        block = targets[row:row + step].astype(np.float64)
        out = np.empty((len(block), wide.shape[1]))
        for col in range(0, wide.shape[1], _COLUMNS):
            part = slice(min(col, wide.shape[1] - 2), col + _COLUMNS)
            out[:, part] = np.einsum("ik,kj->ij", block, wide[:, part].astype(np.float64))
        out = out[:, :n]
        if not np.isfinite(out).all():
            raise ValueError("a score is not finite")
        yield row, out


def _down_the_rows(products: np.ndarray) -> np.ndarray:
    """Sums of the columns in order of the rows. Row after row is added to the sums; a single column would be added in pairs."""
    if products.shape[1] == 1:
        return np.add.accumulate(products, axis=0)[-1]
    return np.add.reduce(products, axis=0)


class Slab:
    """Scores of some targets with all columns of a part, all computed in order."""

    def __init__(self, scores: np.ndarray):
        self.scores = scores

    def __len__(self) -> int:
        return len(self.scores)

    def best(self) -> np.ndarray:
        return self.scores.max(axis=1)

    def far(self) -> float:
        """At least the largest score, sign aside; it itself if that is above 8."""
        return float(np.abs(self.scores).max(initial=0))

    def mad(self) -> np.ndarray:
        return _median(np.abs(self.scores - _median(self.scores)[:, None]))

    def reaching(self, threshold: np.ndarray) -> np.ndarray:
        return (self.scores >= threshold[:, None]).sum(axis=1)

    def top(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, rank, score) of the k[row] best scores per row, ties by column."""
        rows, cols, rank = _top(self.scores, k)
        return rows, cols, rank, self.scores[rows, cols]

    def bins(self, unit: int) -> np.ndarray:
        return np.floor(self.scores * unit).astype(np.int64)

    def within(self, wanted: list[list[int]], unit: int) -> Iterator[np.ndarray]:
        """For each row its scores in the wanted bins of width 1/unit."""
        bins = self.bins(unit)
        for i, own in enumerate(wanted):
            yield self.scores[i][np.isin(bins[i], own)]


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few set places of a matrix, in order, found eight at a time."""
    flat = mask.ravel()
    whole = flat.size // 8 * 8
    found = np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)
    found = np.concatenate([found.ravel(), np.arange(whole, flat.size)])
    return np.divmod(found[flat[found]], mask.shape[1])


class BoundedSlab(Slab):
    """The same answers, bit for bit, from a matrix product and a bound of its error.

    Whatever the order of its sums, a product of vectors of `width` elements is off by at most
    width x unit roundoff x |target| x |column|, nearly. So a score can only matter for a maximum, a middle, a threshold, a bin
    edge or the k-th place if its estimate is within twice the bound of that of the place; those scores alone are
    computed in order, equal columns once. Where they are many, all are, once. `first` tells the first equal column.
    """

    def __init__(self, targets: np.ndarray, columns: np.ndarray, estimates: np.ndarray, slack: np.ndarray, first: Callable):
        self.targets, self.columns, self.estimates, self.slack, self.first = targets, columns, estimates, slack, first
        self.full: Slab | None = None
        self.left = estimates.size // _FEW
        self.folds: np.ndarray | None = None

    @property
    def scores(self) -> np.ndarray:
        return self.all().scores

    def __len__(self) -> int:
        return len(self.estimates)

    def all(self) -> Slab:
        if self.full is None:
            self.full = Slab(np.vstack([part for _, part in _scores(self.targets, self.columns)]))
        return self.full

    def exact(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        if self.full is None and len(rows) > self.left:
            cols = self.first()[cols]
            asked = np.zeros(self.estimates.shape, bool)
            asked[rows, cols] = True
            places = _places(asked)
            if len(places[0]) <= self.left:
                held = np.empty(asked.shape)
                held[places] = self._in_order(*places)
                return held[rows, cols]
        if self.full is not None or len(rows) > self.left:
            return self.all().scores[rows, cols]
        return self._in_order(rows, cols)

    def _in_order(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        self.left -= len(rows)
        out = np.zeros(len(rows))
        for at in range(0, len(rows), _GATHER):
            part = slice(at, at + _GATHER)
            products = np.take(self.targets, rows[part], axis=0).T.astype(np.float64, order="C")
            products *= np.take(self.columns, cols[part], axis=1)
            out[part] += _down_the_rows(products)
        return out

    def _down(self, edge: np.ndarray) -> np.ndarray:
        return np.nextafter(edge.astype(self.estimates.dtype), self.estimates.dtype.type(-np.inf))[:, None]

    def _up(self, edge: np.ndarray) -> np.ndarray:
        return np.nextafter(edge.astype(self.estimates.dtype), self.estimates.dtype.type(np.inf))[:, None]

    def _middle(self, estimates: np.ndarray, slack: np.ndarray, value: Callable) -> np.ndarray:
        """Row medians of `value(rows, cols)`, from estimates of it."""
        n = estimates.shape[1]
        half = n // 2
        split = np.partition(estimates, half, axis=1)
        upper = split[:, half].astype(np.float64)
        lower = upper if n % 2 else split[:, :half].max(axis=1).astype(np.float64)
        reached = estimates >= self._down(lower - 2 * slack)
        below = np.array([n - np.count_nonzero(line) for line in reached])
        reached &= estimates <= self._up(upper + 2 * slack)
        rows, cols = _places(reached)
        found = value(rows, cols)
        found = found[np.lexsort((found, rows))]
        place = np.searchsorted(rows, np.arange(len(estimates))) + half - below
        return found[place] if n % 2 else (found[place - 1] + found[place]) / 2

    def _maxima(self) -> tuple[np.ndarray, int, int]:
        """(maxima, width, number) of folds: that many columns in equal steps make one, the columns left over one each."""
        n = self.estimates.shape[1]
        width = min(max(n // _FOLDS, 1), _FOLD)
        number = n // width
        if self.folds is None:
            whole = self.estimates[:, :number * width].reshape(len(self), width, number).max(axis=1)
            self.folds = np.concatenate([whole, self.estimates[:, number * width:]], axis=1)
        return self.folds, width, number

    def _above(self, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose estimate reaches the floor of their row, in order of the rows; only folds that reach it are read."""
        maxima, width, number = self._maxima()
        rows, folds = _places(maxima >= floor)
        if 4 * width * len(rows) > self.estimates.size:
            return _places(self.estimates >= floor)
        cols = folds[:, None] + number * np.arange(width)
        single = folds >= number
        cols[single] = folds[single, None] + number * (width - 1)
        reached = self.estimates[rows[:, None], cols] >= floor[rows]
        reached[single, 1:] = False
        which, step = np.nonzero(reached)
        return rows[which], cols[which, step]

    def best(self) -> np.ndarray:
        if self.full is not None:
            return self.full.best()
        rows, cols = self._above(self._down(self._maxima()[0].max(axis=1) - 2 * self.slack))
        return np.maximum.reduceat(self.exact(rows, cols), np.searchsorted(rows, np.arange(len(self))))

    def far(self) -> float:
        bound = max(float(self._maxima()[0].max()), -float(self.estimates.min())) + float(self.slack.max())
        return bound if bound <= _FARTHEST else self.all().far()

    def mad(self) -> np.ndarray:
        if self.full is not None:
            return self.full.mad()
        middle = self._middle(self.estimates, self.slack, self.exact)
        # rounding the middle and the differences adds less than the bound itself
        apart = self.estimates - middle.astype(self.estimates.dtype)[:, None]
        np.abs(apart, out=apart)
        return self._middle(apart, 2 * self.slack, lambda rows, cols: np.abs(self.exact(rows, cols) - middle[rows]))

    def reaching(self, threshold: np.ndarray) -> np.ndarray:
        if self.full is not None:
            return self.full.reaching(threshold)
        low, high = self._down(threshold - self.slack), self._up(threshold + self.slack)
        maxima, width, _ = self._maxima()
        if 16 * width * np.count_nonzero(maxima >= low) > self.estimates.size:
            beyond = self.estimates > high
            sure = np.array([np.count_nonzero(line) for line in beyond])
            near, cols = _places((self.estimates >= low) ^ beyond)
        else:
            rows, cols = self._above(low)
            beyond = self.estimates[rows, cols] > high[rows, 0]
            sure = np.bincount(rows[beyond], minlength=len(self))
            near, cols = rows[~beyond], cols[~beyond]
        reached = near[self.exact(near, cols) >= threshold[near]]
        return sure + np.bincount(reached, minlength=len(self))

    def top(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = self.estimates.shape[1]
        most = int(min(k.max(initial=0), n))
        if self.full is not None or most == 0 or most * len(self) > self.left:
            return self.all().top(k)
        # so many folds reach the floor, so at least as many scores do
        maxima = self._maxima()[0]
        floor = np.partition(maxima, maxima.shape[1] - most, axis=1)[:, -most]
        rows, cols = self._above(self._down(floor - 2 * self.slack))
        scores = self.exact(rows, cols)
        order = np.lexsort((cols, -scores, rows))
        rows, cols, scores = rows[order], cols[order], scores[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
        keep = rank <= np.minimum(k, most)[rows]
        return rows[keep], cols[keep], rank[keep], scores[keep]

    def _edges(self, unit: int) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest bin that a score can be in; the slack has room for the rounding here."""
        wide = self._up(self.slack)
        return (np.floor((self.estimates + side) * self.estimates.dtype.type(unit)) for side in (-wide, wide))

    def bins(self, unit: int) -> np.ndarray:
        if self.full is not None:
            return self.full.bins(unit)
        low, high = self._edges(unit)
        rows, cols = _places(low != high)
        out = low.astype(np.int64)
        out[rows, cols] = np.floor(self.exact(rows, cols) * unit).astype(np.int64)
        return out

    def within(self, wanted: list[list[int]], unit: int) -> Iterator[np.ndarray]:
        low, high = self._edges(unit) if self.full is None else (None, None)
        if low is None or (high - low).max() > 1:
            yield from self.all().within(wanted, unit)
            return
        near = np.array([np.isin(a, own) | np.isin(b, own) for a, b, own in zip(low, high, wanted, strict=True)])
        rows, cols = _places(near)
        scores = self.exact(rows, cols)
        ends = np.searchsorted(rows, np.arange(len(self) + 1))
        for i, own in enumerate(wanted):
            mine = scores[ends[i]:ends[i + 1]]
            yield mine[np.isin(np.floor(mine * unit).astype(np.int64), own)]


def _first_equal(columns: np.ndarray) -> np.ndarray:
    """For each column the first one with the same bytes."""
    rows = np.ascontiguousarray(columns.T)
    _, first, which = np.unique(rows.view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel(), return_index=True,
                                return_inverse=True)
    return first[which]


def _norms(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return np.sqrt(np.einsum("ik,ik->i", wide, wide))


def _slabs(targets: np.ndarray, columns: np.ndarray, estimate: type | None) -> Iterator[tuple[int, Slab]]:
    """(first row, scores of some targets). Where few scores are wanted themselves, from estimates: in single precision,
    or in double where bins ask for many edges. Vectors of doubles, whose products are not exact, and scores beyond
    single precision are computed in order in any case."""
    width, n = columns.shape
    if estimate is None or targets.dtype != np.float32 or columns.dtype != np.float32 or width > _WIDEST:
        for row, scores in _scores(targets, columns):
            yield row, Slab(scores)
        return
    far, block, step = _norms(columns.T).max(), max(1, _PRODUCT // n), max(1, _NEAR // n)
    off = 2 * (width + 8) * float(np.finfo(estimate).eps) / 2 * far
    wide, first = columns.astype(estimate, copy=False), cache(partial(_first_equal, columns))
    for start in range(0, len(targets), block):
        product = targets[start:start + block]
        norms = _norms(product)
        with np.errstate(over="ignore", invalid="ignore"):
            products = product.astype(estimate, copy=False) @ wide
        finite = norms.max() * far < float(np.finfo(estimate).max) / 4 or np.isfinite(products).all()
        for row in range(0, len(product), step):
            part, estimates = product[row:row + step], products[row:row + step]
            if finite or np.isfinite(estimates).all():
                yield start + row, BoundedSlab(part, columns, estimates, off * norms[row:row + step] + width * 2.0**-120, first)
            else:
                yield start + row, Slab(np.vstack([scores for _, scores in _scores(part, columns)]))


def _groups(table: pa.Table) -> Iterator[tuple[pa.Scalar, pa.Array, np.ndarray]]:
    """(group, candidate ids, vectors as columns), candidates in id order."""
    order = pc.sort_indices(table, sort_keys=[("group", "ascending"), ("cand_id", "ascending")])
    table = table.take(order)
    runs = pc.run_end_encode(table.column("group").combine_chunks())
    vectors, ids, start = _matrix(table), table.column("cand_id").combine_chunks(), 0
    for group, end in zip(runs.values, runs.run_ends.to_numpy()):
        yield group, ids[start:end], np.ascontiguousarray(vectors[start:end].T)
        start = end


def _median(values: np.ndarray) -> np.ndarray:
    """Row medians. One partition point is enough: the lower middle is the largest value left of it."""
    half = values.shape[1] // 2
    split = np.partition(values, half, axis=1)
    upper = split[:, half]
    return upper if values.shape[1] % 2 else (split[:, :half].max(axis=1) + upper) / 2


def _near_unit(slab: Slab) -> None:
    if slab.far() > _FARTHEST:
        raise ValueError("a deviation needs vectors of about unit norm")


def _sums(scores: np.ndarray) -> tuple[list[int], list[int]]:
    """Exact sums and sums of squares of each row, of scores rounded to 2^-40. Whole numbers add up to the same in any
    order and any split, so a group has one deviation however it is placed."""
    _near_unit(Slab(scores))
    first, second = [0] * len(scores), [0] * len(scores)
    for col in range(0, scores.shape[1], 65_536):
        q = np.rint(scores[:, col:col + 65_536] * _SCALE).astype(np.int64)
        high, low = q >> 20, q & 0xFFFFF
        parts = (q.sum(axis=1), (high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
        for i, (s, hh, hl, ll) in enumerate(zip(*(p.tolist() for p in parts), strict=True)):
            first[i] += s
            second[i] += (hh << 40) + (hl << 21) + ll
    return first, second


def _deviation(scores: np.ndarray) -> np.ndarray:
    """Population standard deviation; the same steps in double as for split groups."""
    n = scores.shape[1]
    mean, square = (np.array([float(x) for x in part]) / n for part in _sums(scores))
    mean, square = mean / _SCALE, square / _SCALE / _SCALE
    return np.sqrt(np.maximum(square - mean * mean, 0.0))


def _by_moments(n: int, width: int) -> bool:
    """Whether a pool of n vectors gets its deviations from their second moments, not from its scores. It goes by the
    whole pool, so that a group has one deviation however it is placed."""
    return width <= _MOMENTS_WIDTH and n >= 2 * width


def _moments(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of the elements of all columns and of the products of two of them (the upper triangle), as whole numbers in
    steps of 2^-40 and 2^-80. They add up to the same in any order and any split."""
    width, n = columns.shape
    if not np.isfinite(columns).all():
        raise ValueError("a score is not finite")
    upper = np.triu_indices(width)
    first, second = np.zeros(width, object), np.zeros(len(upper[0]), object)
    far = np.abs(columns).max(axis=0, initial=0) >= 64
    for k in np.flatnonzero(far):
        line = np.array([int(x) for x in np.rint(np.ldexp(columns[:, k].astype(np.float64), _STEP))], object)
        first, second = first + line, second + line[upper[0]] * line[upper[1]]
    near = columns[:, ~far]
    most = 1 + float(np.ldexp(np.abs(near).max(initial=0).astype(np.float64), _STEP - _LIMB))
    step = int(max(1, min(65_536, _SUMMABLE // max(most, 1 << _LIMB) ** 2)))
    for at in range(0, near.shape[1], step):
        q = np.rint(np.ldexp(near[:, at:at + step].astype(np.float64), _STEP))
        high = np.floor(np.ldexp(q, -_LIMB))
        low = q - np.ldexp(high, _LIMB)
        cross = high @ low.T
        parts = [x[upper].astype(np.int64).astype(object) for x in (high @ high.T, cross + cross.T, low @ low.T)]
        second = second + (parts[0] << 2 * _LIMB) + (parts[1] << _LIMB) + parts[2]
        sums = [x.sum(axis=1).astype(np.int64).astype(object) for x in (high, low)]
        first = first + (sums[0] << _LIMB) + sums[1]
    return first, second


def _covariance(n: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Population covariance of the elements, each entry the double next to its exact value."""
    upper = np.triu_indices(len(first))
    entries = (n * second - first[upper[0]] * first[upper[1]]) / (n * n << 2 * _STEP)
    out = np.empty((len(first), len(first)))
    out[upper] = out[upper[::-1]] = entries.astype(np.float64)
    return out


def _spread(targets: np.ndarray, covariance: np.ndarray) -> np.ndarray:
    """Population standard deviation of the scores of each target: the root of its quadratic form, summed in element order."""
    square = np.empty(len(targets))
    for row, part in _scores(targets, covariance):
        products = np.ascontiguousarray((part * targets[row:row + len(part)]).T)
        square[row:row + len(part)] = _down_the_rows(products)
    return np.sqrt(np.maximum(square, 0.0))


def _count(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below `size` and how often each occurs."""
    if size > 2 * keys.size:
        return np.unique(keys, return_counts=True)
    counts = np.bincount(keys.ravel(), minlength=size)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _top(scores: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rank) of the k[row] best scores per row, ties by column."""
    n, most = scores.shape[1], int(min(k.max(initial=0), scores.shape[1]))
    if most == 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    floor = np.partition(scores, n - most, axis=1)[:, n - most]
    rows, cols = np.nonzero(scores >= floor[:, None])
    order = np.lexsort((cols, -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
    keep = rank <= k[rows]
    return rows[keep], cols[keep], rank[keep]


def _build(parts: dict[str, list], types: dict[str, pa.DataType]) -> pa.Table:
    arrays = {}
    for name, dtype in types.items():
        pieces = [p.cast(dtype) if isinstance(p, (pa.Array, pa.ChunkedArray)) else pa.array(p, dtype)
                  for p in parts.get(name, [])]
        flat = [c for p in pieces for c in (p.chunks if isinstance(p, pa.ChunkedArray) else [p])]
        arrays[name] = pa.chunked_array(flat, dtype)
    return pa.table(arrays)


def _fill(value: pa.Scalar, n: int) -> pa.Array:
    return pa.repeat(value, n)


def _lists(values: pa.Array, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _collect(rows: list[dict], types: dict[str, pa.DataType]) -> pa.Table:
    return _build({name: [row[name] for row in rows] for name in types}, types)


def whole_groups(settings: RetrievalSettings, types: dict[str, pa.DataType], pairs: bool) -> Callable:
    """Cells that hold whole groups: spread, threshold and selection in one go. One row for each pair, or, if `types` asks
    for `cand_ids` and `scores`, one for each target and group with its pairs in lists, best first."""
    packed = "cand_ids" in types

    def run(candidates: pa.Table, targets: pa.Table) -> pa.Table:
        out: list[dict] = []
        if candidates.num_rows and targets.num_rows:
            ids, vectors = targets.column("target_id").combine_chunks(), _matrix(targets)
            for group, cand_ids, columns in _groups(candidates):
                n = columns.shape[1]
                few = not pairs or n >= 2 * _FEW * settings.max_candidates
                form = settings.spread == "sd" and _by_moments(n, len(columns))
                spreads = _spread(vectors, _covariance(n, *_moments(columns))) if form else None
                for row, slab in _slabs(vectors, columns, np.float32 if (form or settings.spread != "sd") and few else None):
                    best = slab.best()
                    if form:
                        _near_unit(slab)
                        spread = spreads[row:row + len(slab)]
                    else:
                        spread = _deviation(slab.scores) if settings.spread == "sd" else slab.mad()
                    delta = settings.scale * spread
                    threshold = best - delta
                    above = slab.reaching(threshold)
                    if pairs:
                        k = np.minimum(np.maximum(above, min(settings.min_candidates, n)), settings.max_candidates)
                        rows, cols, rank, scores = slab.top(k)
                        if packed:
                            ends = np.searchsorted(rows, np.arange(len(slab) + 1))
                            rows = np.arange(len(slab))
                    else:
                        rows, cols, rank, scores = np.arange(len(slab)), None, None, None
                    line = {
                        "target_id": ids.take(pa.array(rows + row)),
                        "group": _fill(group, len(rows)),
                        "n_pool": np.full(len(rows), n),
                        "n_above": above[rows],
                        "max_in_group": best[rows],
                        "delta": delta[rows],
                        "threshold": threshold[rows],
                    }
                    if packed:
                        line |= {"cand_ids": _lists(cand_ids.take(pa.array(cols)), ends), "scores": _lists(pa.array(scores), ends)}
                    elif pairs:
                        line |= {"cand_id": cand_ids.take(pa.array(cols)), "score": scores, "rank_in_group": rank}
                    out.append(line)
        return _collect(out, types)

    return run


def profile(settings: RetrievalSettings, types: dict[str, pa.DataType]) -> Callable:
    """Part of a split group: per target the score histogram ("mad") and the maximum, or ("sd") the maximum alone, and the
    sums of the scores where the part does not prove the group large enough for `deviations`."""

    def run(candidates: pa.Table, targets: pa.Table) -> pa.Table:
        out: list[dict] = []
        if candidates.num_rows and targets.num_rows:
            ids, vectors = targets.column("target_id").combine_chunks(), _matrix(targets)
            for group, _, columns in _groups(candidates):
                form = settings.spread == "sd" and _by_moments(columns.shape[1], len(columns))
                estimate = np.float32 if form else np.float64 if settings.spread != "sd" else None
                for row, slab in _slabs(vectors, columns, estimate):
                    best = slab.best()
                    if settings.spread == "sd":
                        rows = np.arange(len(slab))
                        line = {"n": np.full(len(slab), columns.shape[1]), "s1": [None] * len(slab), "s2": [None] * len(slab)}
                        if form:
                            _near_unit(slab)
                        else:
                            line |= {name: [Decimal(x) for x in part] for name, part in zip(("s1", "s2"), _sums(slab.scores))}
                    else:
                        bins = slab.bins(settings.bins_per_unit)
                        low = bins.min()
                        span = int(bins.max() - low) + 1
                        flat = np.arange(len(bins))[:, None] * span + (bins - low)
                        keys, counts = _count(flat, span * len(bins))
                        rows = keys // span
                        line = {"n": counts, "bin": keys % span + low}
                    out.append(line | {"target_id": ids.take(pa.array(rows + row)),
                                       "group": _fill(group, len(rows)), "top": best[rows]})
        return _collect(out, types)

    return run


def moments(types: dict[str, pa.DataType]) -> Callable:
    """Part of a split group: its size and the exact moments of its vectors, as bytes. None of vectors that are too wide."""

    def run(candidates: pa.Table) -> pa.Table:
        out: list[dict] = []
        for group, _, columns in _groups(candidates):
            if len(columns) <= _MOMENTS_WIDTH:
                sums = b"".join(x.to_bytes(_SUM_BYTES, "little", signed=True) for part in _moments(columns) for x in part.tolist())
                out.append({"group": _fill(group, 1), "n": [columns.shape[1]], "width": [len(columns)], "sums": [sums]})
        return _collect(out, types)

    return run


def covariance(types: dict[str, pa.DataType]) -> Callable:
    """A split group, from the moments of its parts."""

    def run(parts: pa.Table) -> pa.Table:
        n, widths = sum(parts.column("n").to_pylist()), pc.unique(parts.column("width")).to_pylist()
        if len(widths) > 1:
            raise ValueError(f"vectors must have one common length, found {widths}")
        if not _by_moments(n, widths[0]):
            return _collect([], types)
        total = np.zeros(widths[0] * (widths[0] + 3) // 2, object)
        for sums in parts.column("sums").to_pylist():
            total = total + np.array([int.from_bytes(sums[at:at + _SUM_BYTES], "little", signed=True)
                                      for at in range(0, len(sums), _SUM_BYTES)], object)
        found = _covariance(n, total[:widths[0]], total[widths[0]:])
        return _collect([{"group": _fill(parts.column("group")[0], 1), "covariance": [found.ravel()]}], types)

    return run


def deviations(types: dict[str, pa.DataType]) -> Callable:
    """A split group and some targets: the standard deviation of all scores of the group, from its covariance."""

    def run(groups: pa.Table, targets: pa.Table) -> pa.Table:
        out: list[dict] = []
        if groups.num_rows and targets.num_rows:
            ids, vectors = targets.column("target_id").combine_chunks(), _matrix(targets)
            for group, entries in zip(groups.column("group").combine_chunks(), groups.column("covariance").to_pylist()):
                form = np.array(entries).reshape(vectors.shape[1], -1)
                out.append({"target_id": ids, "group": _fill(group, len(ids)), "spread": _spread(vectors, form)})
        return _collect(out, types)

    return run


def _per_target(candidates: pa.Table, bounds: pa.Table, use: Callable, estimate: type, wanted: int = 0) -> list[dict]:
    """Score each group against its own rows of `bounds`; about `wanted` scores are returned for each."""
    out: list[dict] = []
    if candidates.num_rows and bounds.num_rows:
        for group, cand_ids, columns in _groups(candidates):
            mine = bounds.filter(pc.equal(bounds.column("group"), group))
            if mine.num_rows:
                for row, slab in _slabs(_matrix(mine), columns, estimate if len(cand_ids) >= 2 * _FEW * wanted else None):
                    out.append(use(group, cand_ids, slab, mine.slice(row, len(slab))))
    return out


def _carry(bounds: pa.Table, rows: np.ndarray) -> pa.Array:
    """The target's carried statistics on the first of its rows, null on the others."""
    repeat = np.concatenate(([False], rows[1:] == rows[:-1])) if len(rows) else np.empty(0, dtype=bool)
    return bounds.column("carry").combine_chunks().take(pa.array(rows, mask=repeat))


def _wanted(slab: Slab, bounds: pa.Table, unit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct scores in the wanted bins of width 1/unit, their counts)."""
    for i, scores in enumerate(slab.within(bounds.column("bins").to_pylist(), unit)):
        yield i, *np.unique(scores, return_counts=True)


def finer_bins(unit: int, finer: int, types: dict[str, pa.DataType]) -> Callable:
    """Part of a split group: the wanted bins counted again in finer ones, with the number of distinct scores."""

    def use(group: pa.Scalar, _: pa.Array, slab: Slab, bounds: pa.Table) -> dict:
        rows, bins, counts, distinct = [], [], [], []
        for i, values, n in _wanted(slab, bounds, unit):
            found, first, several = np.unique(np.floor(values * finer).astype(np.int64), return_index=True,
                                              return_counts=True)
            rows.append(np.full(len(found), i))
            bins.append(found)
            counts.append(np.add.reduceat(n, first) if len(found) else n)
            distinct.append(several)
        where = np.concatenate(rows)
        return {"target_id": bounds.column("target_id").take(pa.array(where)), "group": _fill(group, len(where)),
                "bin": np.concatenate(bins), "n": np.concatenate(counts), "several": np.concatenate(distinct),
                "carry": _carry(bounds, where)}

    return lambda candidates, bounds: _collect(_per_target(candidates, bounds, use, np.float64), types)


def wanted_values(unit: int, types: dict[str, pa.DataType]) -> Callable:
    """Part of a split group: the distinct scores in the wanted bins, with their counts."""

    def use(group: pa.Scalar, _: pa.Array, slab: Slab, bounds: pa.Table) -> dict:
        found = list(_wanted(slab, bounds, unit))
        where = np.concatenate([np.full(len(values), i) for i, values, _ in found])
        return {"target_id": bounds.column("target_id").take(pa.array(where)), "group": _fill(group, len(where)),
                "value": np.concatenate([values for _, values, _ in found]),
                "n": np.concatenate([n for _, _, n in found]), "carry": _carry(bounds, where)}

    return lambda candidates, bounds: _collect(_per_target(candidates, bounds, use, np.float64), types)


def best_of_part(limit: int, types: dict[str, pa.DataType]) -> Callable:
    """Part of a split group: its best `limit` pairs per target, and on the first of them how many scores of the
    part reach the threshold. The best `limit` of a group are among the best `limit` of its parts."""

    def use(group: pa.Scalar, cand_ids: pa.Array, slab: Slab, bounds: pa.Table) -> dict:
        threshold = bounds.column("carry").combine_chunks().field("threshold").to_numpy()
        above = slab.reaching(threshold)
        rows, cols, rank, scores = slab.top(np.full(len(slab), limit))
        return {"target_id": bounds.column("target_id").take(pa.array(rows)), "group": _fill(group, len(rows)),
                "cand_id": cand_ids.take(pa.array(cols)), "score": scores,
                "above": np.where(rank == 1, above[rows], 0), "carry": _carry(bounds, rows)}

    return lambda candidates, bounds: _collect(_per_target(candidates, bounds, use, np.float32, limit), types)
