"""Mixing documents to target weights of domains, with soft membership.

Only DataFrame functions are used. A naive Bayes classifier over hashed words,
counted from labelled documents, gives each document a posterior over the
domains. Projected gradient steps on a least-squares problem then find rates of
the documents, none negative, whose expected tokens by domain meet the targets.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch, labelled_sample, tucked

#: Hashed words, labelled documents of each domain, and smoothing counts.
SLOTS, FIT_ROWS, SMOOTHING = 1 << 14, 2000, 0.5
#: Standard errors that a word's shares of documents must be apart, and logs that its
#: weight must have, to count.
CERTAIN, LEAST_WEIGHT = 5.0, 1.0
#: Share of the total that a domain may miss its target by; most steps.
TOLERANCE, MOST_STEPS = 1e-4, 60


def words_of(text: Column) -> Column:
    """Slots, from 1, of the words between spaces, tabs and line breaks, in lower case."""
    spaced = F.lower(F.coalesce(text, F.lit("")))
    for space in "\n\t\r":
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    words = F.array_remove(F.split(spaced, " "), "")
    return F.transform(words, lambda w: (F.pmod(F.xxhash64(w), F.lit(SLOTS)) + 1).cast("int"))


def word_weights(sample: DataFrame, domains: list[str]) -> tuple[list[Column], list[float]]:
    """A constant array by slot for each domain, and a constant.

    Summed over the distinct words of a text, and with the constant added, they give
    the log odds of the domain against the first one by the words that the text
    holds, and lacks. Words whose share of documents differs little, or by chance,
    have 0. ``sample`` has text and domain. Arrays have SLOTS numbers of four
    decimals, at any size of the tables.
    """
    found = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    counted = (
        sample.select("domain", F.explode(F.array_distinct(words_of(F.col("text")))).alias("slot"))
        .groupBy("slot")
        .agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(domains)])
    )
    hits = [F.coalesce(f"n{i}", F.lit(0)) + SMOOTHING for i in range(len(domains))]
    sizes = [found.get(d, 0) + 2 * SMOOTHING for d in domains]
    shares = [hit / F.lit(n) for hit, n in zip(hits, sizes, strict=True)]
    columns = []
    for i, (hit, share) in enumerate(zip(hits, shares, strict=True)):
        held = F.log(share / shares[0])
        lacked = F.log((1 - share) / (1 - shares[0]))
        both = (hit + hits[0]) / F.lit(sizes[i] + sizes[0])
        error = F.sqrt(both * (1 - both) * (1 / sizes[i] + 1 / sizes[0]))
        apart = F.abs(share - shares[0]) > CERTAIN * error
        sure = apart & (F.abs(held) > LEAST_WEIGHT)
        columns.append(F.when(sure, held - lacked).otherwise(0.0).alias(f"w{i}"))
        columns.append(F.when(sure, lacked).otherwise(0.0).alias(f"b{i}"))
    slots = sample.sparkSession.range(1, SLOTS + 1).withColumnRenamed("id", "at")
    rows = slots.join(counted, F.col("at") == F.col("slot"), "left").select("at", *columns)
    texts = [
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("at", F.round(f"w{i}", 4).alias("w")))),
                lambda x: x["w"].cast("string"),
            ),
            ",",
        ).alias(f"w{i}")
        for i in range(len(domains))
    ]
    row = rows.agg(*texts, *[F.sum(f"b{i}").alias(f"b{i}") for i in range(len(domains))]).first()
    arrays = [F.split(F.lit(row[f"w{i}"]), ",").cast("array<double>") for i in range(len(domains))]
    return arrays, [row[f"b{i}"] for i in range(len(domains))]


def with_posteriors(
    docs: DataFrame, labelled: DataFrame, domains: list[str], scratch: Scratch, key: str = "doc_id"
) -> tuple[DataFrame, list[bool]]:
    """``docs`` with mix_tokens (words) and mix_p (posterior by domain), as a table, and
    which domains have labelled documents (all of them, if none has).

    The weights of the distinct words are added to the prior, each domain's share of all
    labelled documents.
    """
    counts = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    present = [d in counts or not counts for d in domains]
    total = sum(counts.get(d, 0) + 1 for d in domains)
    prior = [
        math.log((counts.get(d, 0) + 1) / total) if there else -1e6
        for d, there in zip(domains, present, strict=True)
    ]
    sample = scratch.write(labelled_sample(docs, labelled, "domain", FIT_ROWS, 8, key))
    weights, constants = word_weights(sample, domains)
    counted = docs.withColumn("mix_words", words_of(F.col("text")))

    def score(i: int) -> Column:
        summed = F.aggregate(
            F.array_distinct("mix_words"),
            F.lit(0.0),
            lambda total, w: total + F.element_at(weights[i], w),
        )
        return summed + prior[i] + constants[i]

    scores = [F.lit(prior[0])] + [score(i) for i in range(1, len(domains))]
    scored = counted.withColumn("mix_scores", F.array(*scores))
    highest = F.array_max("mix_scores")
    raised = F.transform("mix_scores", lambda x: F.exp(x - highest))
    scored = scored.withColumn("mix_raised", raised)
    summed = F.aggregate("mix_raised", F.lit(0.0), lambda a, x: a + x)
    table = scratch.write(
        scored.select(
            *docs.columns,
            F.size("mix_words").cast("long").alias("mix_tokens"),
            F.transform("mix_raised", lambda x: x / summed).alias("mix_p"),
        )
    )
    return table, present


def _sums(table: DataFrame, columns: list[Column]) -> list[float]:
    row = table.agg(*[F.sum(x).alias(f"s{i}") for i, x in enumerate(columns)]).first()
    return [float(x or 0.0) for x in row]


def fit_rates(table: DataFrame, targets: list[float]) -> Column:
    """The rate of a row of ``table`` as a column over mix_tokens and mix_p.

    Steps go down the gradient of the squared misses, weighted with the inverse
    second moments of the rows that can still move, those with a rate above 0:
    in this metric a step of 1 is the longest safe one while none of them stops.
    If a step makes the misses larger, the next one weights with the moments of
    all rows, for which it is always safe. Rates below 0 are raised to 0. Each
    step is one aggregation of a few sums. A rate is the chain of all steps so
    far over an array of them, so no rate is ever stored. Rates start at 1 and
    stay there if all domains are on target. Where they are not after the last step, as
    with targets out of reach, a warning gives what each domain still misses.
    """
    n = len(targets)
    mass = [F.col("mix_tokens") * F.element_at("mix_p", i + 1) for i in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    total = max(sum(targets), 1e-9)
    steps: list[list[float]] = []
    everything, last = None, math.inf

    def rate_after(steps: list[list[float]]) -> Column:
        def move(rate: Column, step: Column) -> Column:
            return F.greatest(
                F.lit(0.0), rate - sum((x * step[i] for i, x in enumerate(mass)), F.lit(0.0))
            )

        if not steps:
            return F.lit(1.0)
        chain = F.array(*[F.array(*map(F.lit, step)) for step in steps])
        return F.aggregate(chain, F.lit(1.0), move)

    while True:
        current = table.withColumn("mix_rate", rate_after(steps))
        free = F.when(F.col("mix_rate") > 0, 1.0).otherwise(0.0)
        found = _sums(
            current,
            [F.col("mix_rate") * x for x in mass] + [free * mass[i] * mass[j] for i, j in pairs],
        )
        misses, moments = np.array(found[:n]) - np.array(targets), np.zeros((n, n))
        for (i, j), value in zip(pairs, found[n:], strict=True):
            moments[i, j] = moments[j, i] = value
        everything = moments if everything is None else everything
        most = float(np.abs(misses).max())
        if most <= TOLERANCE * total:
            break
        if len(steps) == MOST_STEPS:
            left = ", ".join(f"{x:+.6g}" for x in misses)
            warnings.warn(
                f"after {MOST_STEPS} steps the domains miss their targets by {left} of "
                f"{total:.6g} tokens",
                RuntimeWarning,
                stacklevel=2,
            )
            break
        metric = np.linalg.pinv(moments if most < last else everything, rcond=1e-10)
        last = most
        steps.append([float(f"{x:.12g}") for x in metric @ misses])
    return rate_after(steps)


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    scratch: Scratch,
    key: str = "doc_id",
) -> DataFrame:
    """``docs`` with n_tokens, posterior, rate and copies.

    ``labelled`` has ``key`` and domain; rows with another domain than those of
    ``targets`` are ignored. Targets are shares of the tokens (words); they are
    brought to a sum of 1 and apply to the tokens of all documents. ``rate`` is
    how often a document should be taken; ``copies`` is that number rounded down
    or up by a hash of key and text, so that its expectation is the rate. Columns
    of these names are replaced; all others come through untouched, whatever their names. Texts that are null or without words have no
    tokens, the prior as posterior, and a rate of 1. Repeated rows get the same
    rate. A domain without labelled documents has posterior and target 0, and the
    others share its target; without any labelled documents all posteriors are equal.
    """
    domains = sorted(targets)
    docs, given = tucked(docs.drop("n_tokens", "posterior", "rate", "copies"), [key, "text"], "given")
    marks = labelled.filter(F.col(key).isNotNull() & F.col("domain").isin(domains))
    marks = marks.select(key, "domain")
    table, present = with_posteriors(docs, marks, domains, scratch, key)
    tokens = _sums(table, [F.col("mix_tokens")])[0]
    wanted = [targets[d] if there else 0.0 for d, there in zip(domains, present, strict=True)]
    rate = fit_rates(table, [w / (sum(wanted) or 1.0) * tokens for w in wanted])
    draw = F.pmod(F.xxhash64(F.lit(8), key, "text"), F.lit(1 << 30)) / (1 << 30)
    mixed = table.withColumn("rate", rate)
    copies = F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return mixed.select(
        *given,
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_p").alias("posterior"),
        "rate",
        copies.cast("int").alias("copies"),
    )
