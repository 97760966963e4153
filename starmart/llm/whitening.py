"""Whitening of embeddings by their leading principal components, found by Jacobi-Davidson.

Method: vectors become integers, so sums over them are exact, and the covariance of the different ones
is never formed. A product of it with a few vectors is one Spark job over blocks of centred vectors, of
which each task sends one sum per dimension and vector. Ritz pairs come from a search space
(Rayleigh-Ritz); the space grows by corrections, each the answer of its projected correction equation
by a few MINRES steps, all equations in step so that one job serves them all; converged pairs are
locked. It ends when all residuals are rounding errors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BLOCK_BYTES = 4 << 20
INNER_STEPS = 5
MOST_ROUNDS = 80
# A residual of this many rounding errors of the largest eigenvalue is none.
ROUNDING = 64 * np.finfo(float).eps
# Components whose share of the variance is below this are rounding errors, not directions.
LEAST_SHARE = 1e-12

Product = Callable[[np.ndarray], np.ndarray]


# --- eigenvectors ----------------------------------------------------------------------------------

def minres(apply: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` MINRES steps from zero for each column of ``right``; ``apply`` takes all columns at once."""
    tiny = np.finfo(float).tiny
    norm = lambda block: np.sqrt((block * block).sum(axis=0))
    beta = norm(right)
    last, this = np.zeros_like(right), right / np.maximum(beta, tiny)
    answer = np.zeros_like(right)
    way, way_before = np.zeros_like(right), np.zeros_like(right)
    left, cosine, sine = beta.copy(), np.full_like(beta, -1.0), np.zeros_like(beta)
    delta_bar, epsilon = np.zeros_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        image = apply(this) - beta * last
        alpha = (this * image).sum(axis=0)
        image -= alpha * this
        beta = norm(image)
        delta, gamma_bar = cosine * delta_bar + sine * alpha, sine * delta_bar - cosine * alpha
        epsilon_before, epsilon, delta_bar = epsilon, sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(gamma_bar, beta), tiny)
        cosine, sine = gamma_bar / gamma, beta / gamma
        way, way_before = (this - epsilon_before * way_before - delta * way) / gamma, way
        answer += cosine * left * way
        left = sine * left
        last, this = this, image / np.maximum(beta, tiny)
    return np.where(np.isfinite(answer).all(axis=0), answer, 0.0)


def new_directions(block: np.ndarray, *known: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``block`` adds to the orthonormal columns known."""
    found: list[np.ndarray] = []
    base = np.column_stack(known) if known else np.zeros((len(block), 0))
    for column in block.T:
        size = np.linalg.norm(column)
        if size == 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - base @ (base.T @ column)
            for other in found:
                column = column - other * (other @ column)
        size = np.linalg.norm(column)
        if size > 1e-8 and base.shape[1] + len(found) < len(block):
            found.append(column / size)
    return np.array(found).T if found else np.zeros((len(block), 0))


def leading_eigenpairs(product: Product, size: int, wanted: int, inner_steps: int = INNER_STEPS,
                       rounds: int = MOST_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    ``product`` multiplies a symmetric matrix without negative eigenvalues of ``size`` rows with the
    columns of a block. Block Jacobi-Davidson; equal eigenvalues are found together.
    """
    wanted = min(wanted, size)
    largest_space = max(5 * wanted, 20)
    random = np.random.default_rng(7)
    space = new_directions(random.standard_normal((size, min(size, wanted + 4))))
    images = product(space)
    locked, locked_images = np.zeros((size, 0)), np.zeros((size, 0))
    for _ in range(rounds):
        small = space.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, turn = values[order], turn[:, order]
        space, images = space @ turn, images @ turn
        left = wanted - locked.shape[1]
        scale = max(values[0], *(locked * locked_images).sum(axis=0), 0.0)
        residuals = images[:, :left] - space[:, :left] * values[:left]
        residuals -= locked @ (locked.T @ residuals)
        off = np.linalg.norm(residuals, axis=0) > ROUNDING * scale
        complete = space.shape[1] + locked.shape[1] == size
        done = left if complete or not off.any() else int(np.argmax(off))
        if done:
            locked = np.column_stack([locked, space[:, :done]])
            locked_images = np.column_stack([locked_images, images[:, :done]])
            space, images, residuals, values = space[:, done:], images[:, done:], residuals[:, done:], values[done:]
        if locked.shape[1] == wanted:
            break
        targets = space[:, :left - done]
        if space.shape[1] + targets.shape[1] > largest_space:
            space, images = space[:, :2 * wanted], images[:, :2 * wanted]
        out = np.column_stack([locked, targets])
        project = lambda block: block - out @ (out.T @ block)
        shifts = values[:targets.shape[1]]
        correction = minres(lambda block: project(product(project(block)) - shifts * project(block)),
                            -project(residuals), inner_steps)
        added = new_directions(np.column_stack([correction, residuals]), locked, space)[:, :targets.shape[1]]
        if not added.shape[1]:
            added = new_directions(random.standard_normal((size, 1)), locked, space)
        space, images = np.column_stack([space, added]), np.column_stack([images, product(added)])
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} eigenvectors did not converge in {rounds} rounds")
    small = locked.T @ locked_images
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")
    return values[order], locked @ turn[:, order]


# --- vectors ---------------------------------------------------------------------------------------

def fixed_point(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x): each entry c as floor(64 c) + 1,000,000, a long.

    Rows whose vector is null or holds a null, an infinity or no number are left out, and so are entries
    too large for a long. Vectors shorter than the longest one get zeros behind them.
    """
    entry = lambda c: F.abs(c.cast("double")) < float(2 ** 62 // SCALE)
    usable = F.coalesce(F.forall(vector, entry), F.lit(False))
    rows = embeddings.where(usable).select("vec_id", F.col(vector).alias("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    padded = F.concat(F.transform("v", lambda c: c.cast("double")),
                      F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("v")))
    return rows.select("vec_id", F.transform(
        padded, lambda c: F.floor(F.lit(float(SCALE)) * c).cast("long") + F.lit(SHIFT).cast("long")).alias("x"))


@dataclass(frozen=True)
class Centre:
    """The mean of the different vectors as their number and their sums; small enough for any task."""

    n: int
    sums: list[int]

    def shift(self, x: np.ndarray) -> np.ndarray:
        """x - S / n of the rows of ``x``: whole numbers first, so nothing is lost to the shift."""
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums))
        return (x - np.array(whole, np.int64)).astype(float) - np.array(rest, float) / self.n


@dataclass(frozen=True)
class Fit:
    """The different vectors: their centre, and blocks of them, centred, as doubles."""

    centre: Centre
    blocks: DataFrame

    @property
    def n(self) -> int:
        return self.centre.n

    @property
    def size(self) -> int:
        return len(self.centre.sums)

    def total(self, per_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over blocks of an array per block. A task adds its blocks up and sends one row per
        number; the driver gets one row per number."""
        size = self.size

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in batches:
                for payload in batch.column(0):
                    part = per_block(np.frombuffer(payload.as_buffer(), float).reshape(-1, size)).ravel()
                    held = part if held is None else held + part
            if held is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), pa.array(held)], ["at", "part"])

        rows = (self.blocks.mapInArrow(added, "at long, part double").groupBy("at")
                .agg(F.sum("part").alias("part")).collect())
        found = np.zeros(len(rows))
        for at, part in rows:
            found[at] = part
        return found

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times ``columns``."""
        return self.total(lambda block: block.T @ (block @ columns)).reshape(columns.shape) / self.n


def fit_list(x: DataFrame) -> Fit | None:
    """Each different vector of ``x`` once; None if there is nothing to fit."""
    different = stored(x.select("x").distinct(), "different-vectors")
    rows = (different.select(F.posexplode("x").alias("at", "entry")).groupBy("at")
            .agg(F.sum("entry").alias("s"), F.count(F.lit(1)).alias("n")).collect())  # one row per dimension
    if not rows:
        return None
    sums = [row["s"] for row in sorted(rows, key=lambda row: row["at"])]
    centre = Centre(rows[0]["n"], sums)
    each = max(1, BLOCK_BYTES // (8 * len(sums)))

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, len(sums))
            for at in range(0, len(x), each):
                payload = centre.shift(x[at:at + each]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([payload], pa.binary())], ["payload"])

    return Fit(centre, stored(different.mapInArrow(blocked, "payload binary"), "centred-blocks"))


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors as columns, their eigenvalues, falling, and shares of the whole variance."""

    vectors: np.ndarray
    values: np.ndarray
    shares: np.ndarray
    identity_error: float


def components_of(fit: Fit, wanted: int = COMPONENTS) -> Components:
    """The leading components of the fit list. Directions without variance are none."""
    trace = float(fit.total(lambda block: np.array([(block * block).sum()]))[0]) / fit.n
    if trace == 0:
        return Components(np.zeros((fit.size, 0)), np.zeros(0), np.zeros(0), 0.0)
    values, vectors = leading_eigenpairs(fit.product, fit.size, wanted)
    there = values > LEAST_SHARE * trace
    values, vectors = values[there], vectors[:, there]
    whitener, k = vectors / np.sqrt(values), len(values)

    def moments(block: np.ndarray) -> np.ndarray:
        z = block @ whitener
        return np.append(z.T @ z, z.sum(axis=0))

    found = fit.total(moments) / fit.n
    mean = found[k * k:]
    covariance = found[:k * k].reshape(k, k) - np.outer(mean, mean)
    return Components(vectors, values, values / trace, float(np.abs(covariance - np.eye(k)).max()))


def deviation(x: Column, centre: Centre) -> Column:
    """The sum over dimensions of (n x - S)^2, in exact longs."""
    off = F.zip_with(x, F.array(*[F.lit(s).cast("long") for s in centre.sums]),
                     lambda entry, s: F.lit(centre.n).cast("long") * entry - s)
    return F.aggregate(off, F.lit(0).cast("long"), lambda held, d: held + d * d)


def whiten(embeddings: DataFrame, vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Unusable rows are left out (``fixed_point``). Rows with one vector, or one vec_id, all have their own
    result. There are as many components as dimensions with variance, ``wanted`` at most: a table of equal
    vectors, or of none, gives no rows. Extra columns are ignored. What goes to the driver and to the tasks
    has a few vectors' size.
    """
    x = stored(fixed_point(embeddings, vector), "fixed-point")
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    fit = fit_list(x)
    found = components_of(fit, wanted) if fit else None
    if found is None or not len(found.values):
        return x.sparkSession.createDataFrame([], schema)
    whitener, shares, error = found.vectors / np.sqrt(found.values), found.shares, found.identity_error
    centre, k = fit.centre, len(found.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            entries = batch.column("x").flatten().to_numpy().reshape(rows, len(centre.sums))
            repeated = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(repeated), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, centre.n)), batch.column("deviation").take(repeated),
                pa.array((centre.shift(entries) @ whitener).ravel()), pa.array(np.tile(shares, rows)),
                pa.array(np.full(rows * k, error))], [field.split()[0] for field in schema.split(", ")])

    rows = x.select(F.col("vec_id").cast("long").alias("vec_id"), "x", deviation(F.col("x"), centre).alias("deviation"))
    return rows.mapInArrow(project, schema)
