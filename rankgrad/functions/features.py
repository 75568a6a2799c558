"""Vector features as array expressions: normalise, crop, flip.

The reference normalises images per channel with fixed constants and
augments them with a random crop (pad 4) and a random horizontal flip. Here
a row's feature vector is viewed as a ``side x side`` grid (row-major) of
``channels`` values per cell, interleaved as ``normalize`` takes them; the
grid follows from the vector's length, and all channels of a row share one
offset. A length that makes no square grid fails the job. The "random"
choices come from integer arithmetic on ``(id, epoch)`` so that runs repeat
and SQL can check them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: per-channel mean and deviation of the reference's
# normaliser, given there on the 0-255 scale and divided by 255
CHANNEL_MEAN_255 = (125.3, 123.0, 113.9)
CHANNEL_STD_255 = (63.0, 62.1, 66.7)
CHANNEL_MEAN = tuple(x / 255.0 for x in CHANNEL_MEAN_255)
CHANNEL_STD = tuple(x / 255.0 for x in CHANNEL_STD_255)

# fixed values of the repeatable augmentation: offsets in [-pad, pad]
CROP_X_MULTIPLIER = 7
CROP_Y_MULTIPLIER = 5


def as_double(col: str) -> Column:
    return F.transform(F.col(col), lambda x: x.cast("double"))


def normalize(df: DataFrame, col: str = "embedding", mean: Sequence[float] = CHANNEL_MEAN,
              std: Sequence[float] = CHANNEL_STD, out: str | None = None) -> DataFrame:
    """``(x[i] - mean[c]) / std[c]`` with channel ``c = i % len(mean)``.

    Channels interleave (channel-last layout), so any vector length works;
    with one value per element (``len(mean)`` = vector length) this is an
    element-wise standardisation.
    """
    c = len(mean)
    m = F.array(*[F.lit(float(v)) for v in mean])
    s = F.array(*[F.lit(float(v)) for v in std])
    expr = F.transform(F.col(col), lambda x, i: (x.cast("double") - F.element_at(m, (i % c) + 1))
                       / F.element_at(s, (i % c) + 1))
    return df.withColumn(out or col, expr)


def fit_normalizer(df: DataFrame, col: str = "embedding") -> tuple[list[float], list[float]]:
    """Per-element mean and population deviation over the whole table.

    One partial + final aggregate keyed by element index; the result has
    one row per vector element, so only ``d`` numbers reach the driver.
    """
    stats = df.select(F.posexplode(col).alias("j", "x")) \
        .groupBy("j").agg(F.avg(F.col("x").cast("double")).alias("mu"),
                          F.stddev_pop(F.col("x").cast("double")).alias("sd")) \
        .orderBy("j").collect()
    return [r.mu for r in stats], [r.sd for r in stats]


def crop_offsets(id_col: str, epoch: int | Column, pad: int) -> tuple[Column, Column]:
    e = epoch if isinstance(epoch, Column) else F.lit(epoch)
    span = 2 * pad + 1
    dx = (F.col(id_col) * CROP_X_MULTIPLIER + e) % span - pad
    dy = (F.col(id_col) * CROP_Y_MULTIPLIER + e) % span - pad
    return dx, dy


# An augmentation is an index map: output cell i reads input cell src(i), or
# 0 when src(i) falls outside the grid. Maps compose by substitution, so a
# chain of augmentations reads the input array once per output cell; chaining
# separate array columns instead would let the optimizer inline one array
# expression into the next one's lambda and rebuild it for every cell.

def _crop_map(id_col: str, side: Column, pad: int, epoch: int):
    dx, dy = crop_offsets(id_col, epoch, pad)

    def src(i):
        r = F.floor(i / side) + dy
        c = i % side + dx
        inside = (r >= 0) & (r < side) & (c >= 0) & (c < side)
        return r * side + c, inside
    return src


def _flip_map(id_col: str, side: Column, epoch: int):
    flip = (F.col(id_col) + F.lit(epoch)) % 2 == 1

    def src(i):
        mirrored = F.floor(i / side) * side + (side - 1 - i % side)
        return F.when(flip, mirrored).otherwise(i), F.lit(True)
    return src


def _side(col: str, side: int | None, channels: int) -> Column:
    """Cells per grid row: given, or the root of the vector's cells."""
    if side is not None:
        return F.lit(side)
    return F.round(F.sqrt(F.size(col) / F.lit(channels))).cast("int")


def _gather(col: str, side: Column, channels: int, *maps) -> Column:
    """``out[i] = in[m_last(...m_first(i))]``, 0 where any map leaves the grid.

    ``maps`` are applied output-first: the last augmentation applied to the
    data is the first map here. They map cells; a cell's channels move together.
    """
    x, n = F.col(col), F.size(col)

    def value(i):
        idx, ok = F.floor(i / channels), F.lit(True)
        for m in maps:
            idx, inside = m(idx)
            ok = ok & inside
        return F.when(ok, F.element_at(x, (idx * channels + i % channels + 1).cast("int")).cast("double")).otherwise(F.lit(0.0))

    whole = F.transform(F.sequence(F.lit(0), n - 1), value)
    wrong = F.concat(F.lit(f"no square grid of {channels} channels in a vector of length "), n.cast("string"))
    return F.when(x.isNull(), F.lit(None)).when(n == side * side * channels, whole) \
        .otherwise(F.raise_error(wrong).cast("array<double>"))


def random_crop(df: DataFrame, col: str = "embedding", id_col: str = "vec_id",
                side: int | None = None, pad: int = 4, epoch: int = 0, out: str | None = None,
                channels: int = 1) -> DataFrame:
    """Zero-pad by ``pad`` and cut a ``side x side`` window at offset (dx, dy).

    ``out[r][c] = in[r + dy][c + dx]`` when inside the grid, else 0.
    """
    s = _side(col, side, channels)
    return df.withColumn(out or col, _gather(col, s, channels, _crop_map(id_col, s, pad, epoch)))


def random_flip(df: DataFrame, col: str = "embedding", id_col: str = "vec_id",
                side: int | None = None, epoch: int = 0, out: str | None = None,
                channels: int = 1) -> DataFrame:
    """Mirror each grid row when ``(id + epoch) % 2 = 1``."""
    s = _side(col, side, channels)
    return df.withColumn(out or col, _gather(col, s, channels, _flip_map(id_col, s, epoch)))


def train_transform(df: DataFrame, epoch: int, col: str = "embedding", id_col: str = "vec_id",
                    side: int | None = None, pad: int = 4, mean: Sequence[float] = CHANNEL_MEAN,
                    std: Sequence[float] = CHANNEL_STD, channels: int = 1) -> DataFrame:
    """The training pipeline of the reference: crop, flip, then normalise.

    Crop and flip are fused into one gather (flip's map first, as it is
    applied last), then ``normalize`` reads that array once.
    """
    s = _side(col, side, channels)
    aug = _gather(col, s, channels, _flip_map(id_col, s, epoch), _crop_map(id_col, s, pad, epoch))
    return normalize(df.withColumn(col, aug), col, mean, std)


def test_transform(df: DataFrame, col: str = "embedding", mean: Sequence[float] = CHANNEL_MEAN,
                   std: Sequence[float] = CHANNEL_STD) -> DataFrame:
    """The test pipeline of the reference: normalise only."""
    return normalize(df, col, mean, std)
