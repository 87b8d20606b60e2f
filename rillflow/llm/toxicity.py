"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities and counts of a given lexicon of insults and of a lexicon
learned from labelled texts (words and word beginnings far more frequent in toxic ones), the
largest weight seen, insults near second-person words, capitals, exclamation and question marks,
and words with digits or signs in the middle, also after undoing such disguise.

At most ``SAMPLE`` labelled training documents of either class are learned from (a documented
bound): 60 % of them make the lexicon, 25 % the trees, 15 % the calibration, so that the trees see
honest lexicon hits.  Features cover whole texts of all documents, without a shuffle; the trees are
Spark's own.  Null text counts as empty.  Without labelled documents of both classes the score is
the share of toxic ones.  Repeated rows are scored alike; extra columns are left out.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import blank_split, bucket_of_id, map_arrow, whole_text
from rillflow.llm.labelled import training_sample
from rillflow.session import pin

SAMPLE = 8_000
LEXICON_BELOW, TREES_BELOW = 60, 85
#: A learned unit is in so many toxic texts at least, and so much more likely there (log odds).
LEAST_TEXTS, LEAST_ODDS = 3, 2.5
STEMS = (4, 5)
NEAR = 5

# Common insults and second-person words of English, German, French and Spanish.
INSULTS = (
    "idiot idiots moron morons stupid dumb trash garbage scum loser losers pathetic worthless "
    "disgusting clown clowns fool imbecile bastard bitch jerk creep pig filth vermin "
    "dumm dummkopf trottel abschaum arschloch blödmann versager wertlos widerlich "
    "stupide connard salaud crétin imbécile ordure minable dégueulasse "
    "estúpido idiota basura imbécil asqueroso patético inútil payaso escoria"
).split()
SECOND = (
    "you your you're youre yours u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre tú "
    "ti tus usted ustedes vosotros"
).split()
DISGUISE = str.maketrans("013457@$!|", "oieastasil")
NAMES = (
    "log_words", "insult_density", "insult_count", "near_second", "plain_hits", "plain_density",
    "plain_kinds", "stem_hits", "stem_density", "stem_kinds", "largest", "total",
    "capitals", "exclamations", "questions", "disguised", "disguised_hits",
)


def units_of(texts: pa.Array) -> tuple[dict[str, pa.Array], np.ndarray]:
    """Lower-cased words and their beginnings, for all texts; and each text's number of words."""
    words, sizes = blank_split(pc.utf8_lower(texts))
    words = pc.ascii_trim(words, string.punctuation)
    units = {"": words}
    for n in STEMS:
        units[f"{n}:"] = pc.utf8_slice_codeunits(words, 0, n)
    return units, sizes


def learn_lexicon(texts: DataFrame) -> dict[str, float]:
    """Weights of telling units (prefixed by their kind) from ``label, text``; a bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], int] = Counter()
        for batch in batches:
            units, sizes = units_of(batch["text"])
            labels, ends = batch["label"].to_pylist(), np.cumsum(sizes)
            for kind, column in units.items():
                column = column.to_pylist()
                for label, a, b in zip(labels, ends - sizes, ends):
                    seen.update((kind + u, label) for u in set(column[a:b]) if len(u) > 2)
            seen.update(("", label) for label in labels)
        yield pa.RecordBatch.from_pydict(
            {"unit": [u for u, _ in seen], "label": [y for _, y in seen], "n": list(seen.values())},
            pa.schema([("unit", pa.string()), ("label", pa.int32()), ("n", pa.int64())]),
        )

    counts = (
        map_arrow(texts.select("label", "text"), run, "unit string, label int, n long")
        .groupBy("unit")
        .agg(
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
        )
    )
    counts = pin(counts)
    all_toxic, all_clean = counts.where("unit = ''").select("toxic", "clean").first() or (0, 0)
    odds = F.log((F.col("toxic") + 0.5) / F.lit(all_toxic + 1.0)) - F.log(
        (F.col("clean") + 0.5) / F.lit(all_clean + 1.0)
    )
    telling = counts.where((F.col("unit") != "") & (F.col("toxic") >= LEAST_TEXTS) & (odds >= LEAST_ODDS))
    return {u: w for u, w in telling.select("unit", odds).collect()}  # bounded as the sample is


def features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``doc_id, features`` (in the order of ``NAMES``)."""
    by_kind = {kind: {} for kind in ("", *[f"{n}:" for n in STEMS])}
    for unit, weight in lexicon.items():
        kind = unit[:2] if unit[1:2] == ":" and unit[:1].isdigit() and unit[:2] in by_kind else ""
        by_kind[kind][unit[len(kind) :]] = weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = {k: (pa.array(list(d), pa.string()), np.array([*d.values(), 0.0])) for k, d in by_kind.items()}
        insults, second = pa.array(INSULTS), pa.array(SECOND)
        for batch in batches:
            text = batch["text"]
            units, sizes = units_of(text)
            n = len(sizes)
            owner = np.repeat(np.arange(n), sizes)
            count = lambda mask: np.bincount(owner[mask], minlength=n).astype(float)
            words = units[""]
            is_in = lambda column, values: pc.is_in(column, value_set=values).to_numpy(zero_copy_only=False)
            insult, you = is_in(words, insults), is_in(words, second)
            odd = pc.match_substring_regex(words, "[a-z][0-9@$!*|]+[a-z]").to_numpy(zero_copy_only=False)
            undone = np.zeros(len(words), bool)
            for i in np.flatnonzero(odd):
                undone[i] = words[int(i)].as_py().translate(DISGUISE) in INSULTS_SET
            hits, weights, kinds = {}, np.zeros(len(words)), {}
            for kind, (values, weight) in sets.items():
                at = pc.fill_null(pc.index_in(units[kind], value_set=values), len(values)).to_numpy(zero_copy_only=False)
                hit = at < len(values)
                hits[kind] = hit
                weights = np.maximum(weights, weight[at])
                pairs = np.unique(owner[hit].astype(np.int64) * (len(values) + 1) + at[hit])
                kinds[kind] = np.bincount(pairs // (len(values) + 1), minlength=n).astype(float)
            stem = np.logical_or.reduce([hits[k] for k in sets if k])
            # insults at most NEAR words from a second-person word of the same text
            bad, at_you = np.flatnonzero(insult | hits[""] | stem), np.flatnonzero(you)
            near = np.zeros(len(words), bool)
            if len(bad) and len(at_you):
                right = np.searchsorted(at_you, bad)
                for side in (np.minimum(right, len(at_you) - 1), np.maximum(right - 1, 0)):
                    close = (np.abs(at_you[side] - bad) <= NEAR) & (owner[at_you[side]] == owner[bad])
                    near[bad[close]] = True
            largest = np.zeros(n)
            np.maximum.at(largest, owner, weights)
            size = np.maximum(sizes, 1)
            chars = np.maximum(pc.utf8_length(text).to_numpy(zero_copy_only=False), 1)
            signs = lambda pattern: pc.count_substring_regex(text, pattern).to_numpy(zero_copy_only=False)
            plain, stems = count(hits[""]), count(stem)
            columns = [
                np.log1p(sizes), count(insult) / size, count(insult), count(near), plain, plain / size,
                kinds[""], stems, stems / size, sum(kinds[k] for k in sets if k), largest,
                np.bincount(owner, weights, n), signs("[A-Z]") / chars, signs("!") / chars,
                signs(r"\?") / chars, count(odd) / size, count(undone),
            ]
            table = np.stack(columns, 1).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.ListArray.from_arrays(np.arange(0, table.size + 1, table.shape[1], dtype=np.int32), table.ravel()),
                ],
                names=["doc_id", "features"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return map_arrow(rows, run, "doc_id long, features array<double>")


INSULTS_SET = frozenset(INSULTS)


def fit_and_score_with(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """``doc_id, score``."""
    sample = pin(training_sample(labels, "toxic", train, SAMPLE))
    chosen = F.broadcast(sample)  # at most 2 * SAMPLE rows of three numbers
    lexicon = learn_lexicon(
        docs.select("doc_id", whole_text().alias("text")).join(
            F.broadcast(sample.where(F.col("part") < LEXICON_BELOW)), "doc_id"
        )
    )
    every = features(docs, lexicon)
    known = pin(
        features(docs.join(chosen.where(F.col("part") >= LEXICON_BELOW).select("doc_id"), "doc_id", "left_semi"), lexicon)
        .join(chosen, "doc_id")
        # all tasks scan, the chosen rows alone move; sorted, so that reruns add up alike
        .repartition(2, "doc_id")
        .sortWithinPartitions("doc_id", "features")
        .select(array_to_vector("features").alias("features"), F.col("label").cast("double"), "part")
    )
    for_trees, for_curve = known.where(F.col("part") < TREES_BELOW), known.where(F.col("part") >= TREES_BELOW)
    both = lambda df: df.agg(F.countDistinct("label")).first()[0] == 2
    if not both(for_trees):
        toxic, n = sample.agg(F.sum("label"), F.count("label")).first()
        return every.select("doc_id", F.lit(((toxic or 0) + 1) / (n + 2)).alias("score"))
    trees = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, maxBins=32, seed=1, minInstancesPerNode=2)
    model = trees.fit(for_trees)
    chance = lambda df: model.transform(df).withColumn("chance", vector_to_array("probability")[1])
    scored = chance(every.withColumn("features", array_to_vector("features")))
    if both(for_curve):
        isotonic = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="curve")
        scored = isotonic.fit(chance(for_curve).select("chance", "label")).transform(
            scored.select("doc_id", "chance")
        )
        # the trees' own probability keeps documents of one step of the curve apart
        value = 0.98 * F.col("curve") + 0.02 * F.col("chance")
    else:
        value = F.col("chance")
    return scored.select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)).alias("score"))


def fit_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = bucket_of_id("doc_id", 5) == 0
    return fit_and_score_with(docs, labels, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
