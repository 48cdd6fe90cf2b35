"""Attribution of spectra to known signatures: bootstrap, non-negative fit, two tiers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

FITTED = "sample string, replicate int, signature string, exposure double"


def nnls(a: np.ndarray, b: np.ndarray, steps: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    gram, target = a.T @ a, a.T @ b
    tolerance = 1e-10 * max(1.0, float(np.abs(target).max(initial=0.0)))
    for _ in range(steps or 30 * n):
        slope = target - gram @ x
        slope[free] = -np.inf
        if n == 0 or slope.max() <= tolerance:
            break
        free[int(slope.argmax())] = True
        while True:
            trial = np.zeros(n)
            trial[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if trial[free].min(initial=1.0) > 0:
                x = trial
                break
            down = free & (trial <= 0)
            step = min(1.0, float((x[down] / np.maximum(x[down] - trial[down], 1e-300)).min()))
            x = x + step * (trial - x)
            free &= x > tolerance * 1e-3
            x[~free] = 0.0
            if not free.any():
                break
    return x


def misfit(a: np.ndarray, x: np.ndarray, b: np.ndarray) -> float:
    """Length of what a x leaves of b, as a share of b's."""
    size = float(np.linalg.norm(b))
    return float(np.linalg.norm(a @ x - b)) / size if size > 0 else 0.0


def selected(a: np.ndarray, b: np.ndarray, gain: float, loss: float) -> np.ndarray:
    """A sparse non-negative fit: columns leave while the misfit grows by less than `loss` each, then enter while it shrinks by `gain` or more.

    Of columns to leave the one that costs least goes first; of those to enter the one that gains most. The
    criterion is our own. Of equal ones the first counts.
    """
    x = nnls(a, b)
    kept = np.flatnonzero(x > 0)
    error = misfit(a, x, b)

    def fitted(columns) -> tuple[float, np.ndarray]:
        out = np.zeros(a.shape[1])
        out[columns] = nnls(a[:, columns], b)
        return misfit(a, out, b), out

    while len(kept) > 1:
        tried = [(*fitted(np.delete(kept, k)), k) for k in range(len(kept))]
        worse, fit_, k = min(tried, key=lambda t: t[0])
        if worse - error >= loss:
            break
        kept, error, x = np.delete(kept, k), worse, fit_
    while len(kept) < a.shape[1]:
        others = np.setdiff1d(np.arange(a.shape[1]), kept)
        tried = [(*fitted(np.sort(np.append(kept, k))), k) for k in others]
        better, fit_, k = min(tried, key=lambda t: t[0])
        if error - better < gain:
            break
        kept, error, x = np.sort(np.append(kept, k)), better, fit_
    return x


def resampled(counts: np.ndarray, sample: str, replicate: int, seed: int, poisson: bool = False) -> np.ndarray:
    """A bootstrap spectrum; its generator depends on seed, sample and replicate alone. Replicate 0 is the spectrum itself."""
    if replicate == 0:
        return counts
    rng = np.random.default_rng([seed, zlib.crc32(sample.encode()), replicate])
    if poisson:
        return rng.poisson(counts).astype(float)
    total = counts.sum()
    share = counts / total if total > 0 else np.full(len(counts), 1 / len(counts))
    return rng.multinomial(int(round(total)), share).astype(float)


def fit(
    spectra: DataFrame, signatures: DataFrame, replicates: int = 1000, seed: int = 12_345, poisson: bool = False, chunk: int = 100, allowed: DataFrame | None = None, selection: tuple[float, float] | None = None
) -> DataFrame:
    """sample, replicate, signature, exposure of every sample's spectrum and its bootstrap replicates.

    spectra: sample, ord, value. signatures: signature, ord, weight, a table
    of some hundred rows a signature that goes to every task. A sample's
    replicates are dealt out in chunks, so that one sample is many tasks.
    allowed: sample, group, signatures (an array); then a sample is fitted with these only, once
    for each of its rows there, and the result has `group`. Each task takes its
    own columns of the signatures. selection: (gain, loss) of `selected`; without it all signatures may take part.
    """
    table = signatures.toPandas().pivot_table(index="ord", columns="signature", values="weight", fill_value=0.0).sort_index()  # a reference table
    names, matrix, order = list(table.columns), table.to_numpy(float), list(table.index)
    arrays = spectra.groupBy("sample").agg(F.collect_list(F.struct("ord", F.col("value").cast("double").alias("value"))).alias("cells"))  # as many cells as types
    if allowed is not None:
        arrays = arrays.join(allowed.select("sample", "group", "signatures"), "sample")
    else:
        arrays = arrays.withColumn("group", F.lit(None).cast("string")).withColumn("signatures", F.lit(None).cast("array<string>"))
    tasks = arrays.withColumn("first", F.explode(F.sequence(F.lit(0), F.lit(replicates), F.lit(chunk)))).repartition("sample", "group", "first")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for sample, group, cells, own, first in zip(frame["sample"], frame["group"], frame["cells"], frame["signatures"], frame["first"], strict=True):
                value = {c["ord"]: c["value"] for c in cells}
                counts = np.array([value.get(k, 0.0) for k in order])
                columns = list(range(len(names))) if own is None else [k for k, name in enumerate(names) if name in set(own)]
                part, last = matrix[:, columns], min(first + chunk - 1, replicates)
                drawn = (resampled(counts, sample, k, seed, poisson) for k in range(first, last + 1))
                found = [nnls(part, x) if selection is None else selected(part, x, *selection) for x in drawn]
                yield pd.DataFrame({"sample": sample, "group": group, "replicate": np.repeat(np.arange(first, last + 1), len(columns)), "signature": [names[k] for k in columns] * len(found), "exposure": np.concatenate(found)})

    fitted = tasks.mapInPandas(run, f"sample string, group string, {FITTED.removeprefix('sample string, ')}")
    return fitted if allowed is not None else fitted.drop("group")


def intervals(fitted: DataFrame) -> DataFrame:
    """sample, group (if fitted has it), signature, point, boot_mean, lo95, hi95, detected: a signature is detected if its lower limit is above 0."""
    drawn = F.when(F.col("replicate") > 0, F.col("exposure"))
    out = fitted.groupBy("sample", *[c for c in ("group",) if c in fitted.columns], "signature").agg(
        F.max(F.when(F.col("replicate") == 0, F.col("exposure"))).alias("point"),
        F.avg(drawn).alias("boot_mean"),
        F.percentile(drawn, F.lit(0.025)).alias("lo95"),
        F.percentile(drawn, F.lit(0.975)).alias("hi95"),
    )
    return out.withColumn("detected", F.coalesce(F.col("lo95") > 0, F.lit(False)))


def pooled(spectra: DataFrame, groups: DataFrame) -> DataFrame:
    """Group spectra as samples: sample (the group's name), ord, value."""
    return spectra.join(groups, "sample").groupBy(F.col("group").alias("sample"), "ord").agg(F.sum("value").alias("value"))


def validated(found: DataFrame, groups: DataFrame, min_samples: int = 3) -> DataFrame:
    """group, signature, n_samples_detected, n_samples, validated."""
    sizes = groups.groupBy("group").agg(F.countDistinct("sample").alias("n_samples"))
    counted = found.join(groups, "sample").groupBy("group", "signature").agg(F.count_if("detected").alias("n_samples_detected"))
    return counted.join(sizes, "group").withColumn("validated", F.col("n_samples_detected") >= min_samples)


def attribute(
    spectra: DataFrame,
    signatures: DataFrame,
    groups: DataFrame,
    replicates: int = 1000,
    min_samples: int = 3,
    seed: int = 12_345,
    merge_groups: bool = False,
    poisson: bool = False,
    selection: tuple[float, float] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(first-tier intervals, final exposures): the second fit uses a group's validated signatures only.

    merge_groups: the first tier fits each group's summed spectrum, and one detection validates.
    The second fits of all groups are one job: a sample's tasks carry its group's signatures.
    selection: (gain, loss) of a stepwise first tier; see `selected`.
    """
    first = pooled(spectra, groups) if merge_groups else spectra
    tiers = groups.select(F.col("group").alias("sample"), "group").distinct() if merge_groups else groups
    found = intervals(fit(first, signatures, replicates, seed, poisson, selection=selection))
    final = second_tier(spectra, signatures, groups, validated(found, tiers, 1 if merge_groups else min_samples), replicates, seed, poisson)
    return found, final


def second_tier(spectra: DataFrame, signatures: DataFrame, groups: DataFrame, summary: DataFrame, replicates: int = 1000, seed: int = 12_345, poisson: bool = False) -> DataFrame:
    """sample, group, signature, exposure, lo95, hi95: each sample fitted with its group's validated signatures. summary: `validated`."""
    kept = summary.where("validated").groupBy("group").agg(F.sort_array(F.collect_set("signature")).alias("signatures"))  # signatures are a reference table
    allowed = groups.select("sample", "group").distinct().join(kept, "group")
    fitted = intervals(fit(spectra, signatures, replicates, seed + 1, poisson, allowed=allowed))
    return fitted.select("sample", "group", "signature", F.col("point").alias("exposure"), "lo95", "hi95")


def validated_lists(summary: DataFrame) -> DataFrame:
    """group, signatures: each group's validated signatures in order, a row for every group; summary: `validated`."""
    return summary.groupBy("group").agg(F.sort_array(F.collect_set(F.when(F.col("validated"), F.col("signature")))).alias("signatures")).orderBy("group")


def activities(exposures: DataFrame, signatures: DataFrame, value: str = "exposure") -> DataFrame:
    """sample and a column for each signature of the reference table, in its order: a tier as a matrix; what wasn't fitted is 0."""
    names = sorted(r.signature for r in signatures.select("signature").distinct().collect())  # a reference table
    return exposures.groupBy("sample").pivot("signature", names).agg(F.sum(value)).na.fill(0.0, names).orderBy("sample")
