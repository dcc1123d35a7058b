"""Quality classifier from weak labels.

Heuristic labellers look at a document and vote good, bad or not at all. Their votes overlap and err, so
expectation-maximisation estimates, for each labeller, how it votes on good and on bad documents, and from
that the posterior of every combination of votes. Hand-made labels, where a table of them is given, are one more
labeller that abstains elsewhere. The posteriors train a linear scorer over hashed words and votes, which scores all documents.

Form (is it well-made prose?) and abuse (does it insult?) are judged by a model and a scorer each, as either can be
fine without the other; a document is kept if both are good. One abuse labeller learns its words from about ``label_rows``
labelled documents: words that stand in many different surroundings in toxic documents and hardly in others.
Surroundings, not documents, are counted, so copies count once.

EM needs only how often each combination of votes occurs: counts over all documents, at most ``3 ** labellers`` rows, so it
runs on the driver at any corpus size. The scorer is fitted on a sample of about ``train_rows`` documents, chosen by a hash of
the row (fewer rows than that: all of them), by one task; this bound is a parameter and the only sampling here besides ``label_rows``. Every
document is scored on its whole text.

Defined cases: a null, empty or white text has score 0 and is rejected; a table without labels, or no table of labels,
works on the heuristics alone; labels repeated for an id count as bad if any is; null ids have no label; repeated rows score
alike; an empty table gives an empty result; very long texts are read whole; columns other than id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolith.llm.common import free_name, keyed, text_bytes

TRAIN_ROWS = 20_000
LABEL_ROWS = 10_000
BUCKETS = 1 << 14
GOOD, BAD, NONE = 2, 0, 1

#: Frequent function words of the languages judged.
STOP_WORDS = frozenset(
    "the of and to in is that it was for on are with as be this have from or by not "
    "le la les de des du et un une en que qui dans pour pas sur est au "
    "der die das und ist von mit den dem ein eine zu nicht auf sich "
    "el los las del y por con para una no se lo su al".encode().split()
)
#: Plain insults.
INSULTS = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown clowns imbecile "
    "dumbass bastard bitch asshole jerk retard freak creep vermin filth subhuman".encode().split()
)
_SYMBOLS = b"#$%&*|@<>{}[]^~_+=\\/"
_UPPER, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
_EDGE = b".,;:!?\"'()[]{}*#$%&-|"
_SHOUT = re.compile(rb"[!?]{2,}")


def _share(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def labellers(text: bytes, learnt: frozenset[bytes] = frozenset()) -> tuple[int, ...]:
    """The votes of ``FORM``, then of ``ABUSE``, in their order; ``learnt`` are words of abuse."""
    size = len(text)
    words = text.split()
    if not words:
        return (*(BAD,) * len(FORM), *(GOOD,) * len(ABUSE))
    plain = [w.strip(_EDGE) for w in text.lower().split()]
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    symbols = _share(text, _SYMBOLS) / size
    letters, upper = _share(text, _LETTERS), _share(text, _UPPER)
    same = len(set(lines)) / len(lines)
    variety = len(set(plain)) / n
    stops = sum(map(STOP_WORDS.__contains__, plain)) / n
    mean = size / n - 1
    shouts = len(_SHOUT.findall(text)) / n
    return (
        BAD if symbols > 0.03 else GOOD if symbols < 0.005 else NONE,
        BAD if letters > 20 and upper > 0.4 * letters else GOOD if upper < 0.15 * letters else NONE,
        BAD if len(lines) > 3 and same < 0.6 else GOOD if same > 0.9 else NONE,
        BAD if n >= 40 and variety < 0.25 else GOOD if variety > 0.5 else NONE,
        BAD if n >= 30 and stops < 0.02 else GOOD if stops >= 0.06 else NONE,
        BAD if n >= 20 and not 3.5 < mean < 7.5 else GOOD if 4 < mean < 7 else NONE,
        BAD if n >= 60 and not _share(text, b".?!") else GOOD if words[-1][-1:] in b".?!" else NONE,
        BAD if shouts > 0.15 else GOOD if shouts < 0.02 else NONE,
        GOOD if INSULTS.isdisjoint(plain) else BAD,
        GOOD if learnt.isdisjoint(plain) else BAD,
    )


FORM = ("symbols", "capitals", "lines", "variety", "function_words", "word_length", "stops", "shouts")
ABUSE = ("insults", "learnt_words")
LABELLERS = FORM + ABUSE
#: The votes that each model and scorer sees.
_TASKS = (slice(0, len(FORM)), slice(len(FORM), len(LABELLERS)))


def pattern(votes: tuple[int, ...]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v
    return code


def votes_of(code: int, count: int) -> list[int]:
    out = []
    for _ in range(count):
        out.append(code % 3)
        code //= 3
    return out[::-1]


@dataclass
class LabelModel:
    """``chances[k, y, v]``: how labeller ``k`` votes ``v`` on bad (0) and good (1) documents."""

    prior: float
    chances: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of good for rows of votes."""
        each = np.arange(votes.shape[1])
        good = np.log(self.prior) + np.log(self.chances[each, 1, votes]).sum(1)
        bad = np.log1p(-self.prior) + np.log(self.chances[each, 0, votes]).sum(1)
        return 1 / (1 + np.exp(np.clip(bad - good, -60, 60)))

    def accuracies(self) -> np.ndarray:
        """Of each labeller: how often it is right when it votes."""
        right = self.prior * self.chances[:, 1, GOOD] + (1 - self.prior) * self.chances[:, 0, BAD]
        wrong = self.prior * self.chances[:, 1, BAD] + (1 - self.prior) * self.chances[:, 0, GOOD]
        return right / (right + wrong)


def fit_label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> LabelModel:
    """EM from the start that any vote for bad makes a document likely bad, as heuristics seldom fire on good text."""
    good = np.where((votes == BAD).any(1), 0.15, 0.95)
    model = LabelModel(0.8, np.full((votes.shape[1], 2, 3), 1 / 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        chances = np.stack([[[(w * (column == v)).sum() for v in range(3)] for w in weight] for column in votes.T])
        chances += 0.5
        model = LabelModel(
            float(np.clip(weight[1].sum() / counts.sum(), 0.02, 0.98)), chances / chances.sum(2, keepdims=True)
        )
        good = model.posterior(votes)
    return model


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh32_intdigest(word) % BUCKETS
        return value


_BUCKETS = _Buckets()


def features(text: bytes, votes: tuple[int, ...]) -> tuple[np.ndarray, list[int]]:
    """Hashed words, each bucket once, and a bucket per vote."""
    words = np.unique(np.fromiter(map(_BUCKETS.__getitem__, text.lower().split()), np.int32))
    return words, [BUCKETS + 3 * k + v for k, v in enumerate(votes)]


def _word_weight(count: int) -> float:
    return 1 / np.sqrt(max(count, 1))


def fit_scorer(rows: list[tuple[np.ndarray, list[int], float]], epochs: int = 120, rate: float = 0.5) -> np.ndarray:
    """Weights of a logistic scorer, the bias last: full-batch adaptive gradient descent towards the posteriors."""
    size = BUCKETS + 3 * len(LABELLERS) + 1
    weights, squares = np.zeros(size), np.full(size, 1e-8)
    if not rows:
        return weights
    columns = np.concatenate([np.concatenate((w, v, [size - 1])) for w, v, _ in rows]).astype(np.int64)
    values = np.concatenate([np.concatenate((np.full(len(w), _word_weight(len(w))), np.ones(len(v) + 1))) for w, v, _ in rows])
    which = np.repeat(np.arange(len(rows)), [len(w) + len(v) + 1 for w, v, _ in rows])
    target = np.array([p for _, _, p in rows])
    for _ in range(epochs):
        score = np.bincount(which, weights[columns] * values, len(rows))
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) / len(rows)
        gradient = np.bincount(columns, error[which] * values, size) + 1e-5 * weights
        squares += gradient**2
        weights -= rate * gradient / np.sqrt(squares)
    return weights


@dataclass
class Classifier:
    """A label model and a scorer's weights for form and for abuse, and the learnt words."""

    labels: list[LabelModel]
    weights: list[np.ndarray]
    learnt: frozenset[bytes] = frozenset()

    def scores(self, text: bytes) -> list[float]:
        """The scorers' probabilities that form and tone are good."""
        if not text.split():
            return [0.0, 1.0]
        votes = labellers(text, self.learnt)
        words, cells = features(text, votes)
        out = []
        for weights, part in zip(self.weights, _TASKS, strict=True):
            raw = weights[words].sum() * _word_weight(len(words)) + weights[cells[part]].sum() + weights[-1]
            out.append(float(1 / (1 + np.exp(-np.clip(raw, -30, 30)))))
        return out

    def score(self, text: bytes) -> float:
        return min(self.scores(text))


def _given(labels: DataFrame, id_col: str) -> DataFrame:
    """``id, form, abuse``: the votes of the labels."""
    flag = lambda bad: F.min(F.when(bad, BAD).when(~bad, GOOD))
    return labels.groupBy(F.col(id_col).alias("id")).agg(
        flag(F.col("quality") < 1).alias("form"), flag(F.col("toxic") > 0).alias("abuse")
    )


def _with_labels(votes: DataFrame, labels: DataFrame | None, id_col: str) -> DataFrame:
    if labels is None:
        return votes.withColumns({"form": F.lit(NONE), "abuse": F.lit(NONE)})
    joined = votes.join(_given(labels, id_col), "id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(NONE)) for c in ("form", "abuse")})


def _sampled(frame: DataFrame, rows: int, total: float, *columns: str) -> DataFrame:
    """About ``rows`` of ``total`` rows, told by a hash."""
    mark = F.pmod(F.xxhash64(*columns, F.lit(9)), F.lit(1 << 30))
    return frame.where(mark < F.lit(int(min(1.0, rows / max(total, 1)) * (1 << 30))))


def learn_words(rows: DataFrame, labels: DataFrame, id_col: str, label_rows: int = LABEL_ROWS) -> frozenset[bytes]:
    """Words of abuse: in at least 4 surroundings, and 1 % as many as there are toxic documents, and
    20 times as many as in other documents. So few words can be that frequent that the result is small."""
    given = _given(labels, id_col).where("abuse is not null")
    chosen = _sampled(given, label_rows, given.count(), "id").select("id", (F.col("abuse") == BAD).alias("toxic"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, around, toxic = [], [], []
            for text, bad in zip(text_bytes(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
                plain = [b"", *(w.strip(_EDGE) for w in text.lower().split()), b""]
                uses = {(w, xxhash.xxh64_intdigest(a + b" " + b) >> 1) for a, w, b in zip(plain, plain[1:], plain[2:], strict=False)}
                for word, place in uses:
                    found.append(word)
                    around.append(place)
                toxic.extend([bad] * len(uses))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(around, pa.int64()), pa.array(toxic, pa.bool_())], names=["word", "around", "toxic"])

    # At most about label_rows ids.
    texts = rows.join(F.broadcast(chosen), "id").select("text", "toxic")
    uses = texts.mapInArrow(words, "word binary, around long, toxic boolean")
    counted = (
        uses.distinct().groupBy("word")
        .agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("fine"))
        .where("bad >= 4 and bad >= 20 * fine")
    )
    least = chosen.where("toxic").count() / 100
    return frozenset(bytes(r["word"]) for r in counted.where(F.col("bad") >= least).select("word").collect())


def train(documents: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
          train_rows: int = TRAIN_ROWS, label_rows: int = LABEL_ROWS) -> Classifier:
    rows = keyed(documents, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    learnt = frozenset() if labels is None else learn_words(rows, labels, id_col, label_rows)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [pattern(labellers(t, learnt)) for t in text_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(codes, pa.int32())], names=["id", "votes"])

    voted = rows.mapInArrow(vote, f"id {kind}, votes int")
    counted = _with_labels(voted, labels, id_col).groupBy("votes", "form", "abuse").count().collect()  # bounded, see above
    kinds = len(LABELLERS)
    seen = np.array([votes_of(r["votes"], kinds) for r in counted], int).reshape(-1, kinds)
    given = np.array([[r["form"], r["abuse"]] for r in counted], int).reshape(-1, 2)
    counts = np.array([r["count"] for r in counted], float)
    if not len(counts):
        flat = [LabelModel(0.5, np.full((kinds, 2, 3), 1 / 3))] * 2
        return Classifier(flat, [fit_scorer([])] * 2, learnt)
    models = [fit_label_model(np.column_stack([seen[:, t], given[:, k]]), counts) for k, t in enumerate(_TASKS)]
    drawn = _with_labels(_sampled(rows, train_rows, counts.sum(), "id", "text_key"), labels, id_col)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, votes, targets = [], [], []
            for text, *held in zip(text_bytes(batch, "text"), batch.column("form").to_pylist(), batch.column("abuse").to_pylist(), strict=True):
                cast = labellers(text, learnt)
                w, v = features(text, cast)
                words.append(w)
                votes.append(v)
                targets.append([float(m.posterior(np.array([[*cast[t], held[k]]]))[0]) for k, (m, t) in enumerate(zip(models, _TASKS, strict=True))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.int32())), pa.array(votes, pa.list_(pa.int32())), pa.array(targets, pa.list_(pa.float64()))],
                names=["words", "votes", "targets"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = []
        for batch in batches:
            words = [np.asarray(w.values) for w in batch.column("words")]
            sample.extend(zip(words, batch.column("votes").to_pylist(), batch.column("targets").to_pylist(), strict=True))
        fitted = [fit_scorer([(w, v[t], p[k]) for w, v, p in sample]) for k, t in enumerate(_TASKS)]
        yield pa.RecordBatch.from_arrays([pa.array(fitted, pa.list_(pa.float64()))], names=["weights"])

    described = drawn.mapInArrow(describe, "words array<int>, votes array<int>, targets array<double>")
    fitted = described.repartition(1).mapInArrow(fit, "weights array<double>").collect()
    return Classifier(models, [np.array(r["weights"]) for r in fitted], learnt)


def classify(documents: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text",
             least: float = 0.5) -> DataFrame:
    """Per row: id, ``text_key``, ``score`` (the lesser of form and tone) and ``keep`` (score of at least ``least``)."""
    rows = keyed(documents, id_col, text_col)
    sent = documents.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sent.value.score(t) for t in text_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_key"), pa.array(scores, pa.float64())], names=["id", "text_key", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"id {kind}, text_key long, score double")
    return scored.select(F.col("id").alias(id_col), "text_key", "score", (F.col("score") >= least).alias("keep"))


def keep_good(documents: DataFrame, classifier: Classifier, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that the classifier keeps, with all their columns; nothing is shuffled."""
    flag = free_name(documents, "__score")
    sent = documents.sparkSession.sparkContext.broadcast(classifier)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(lambda t: sent.value.score((t or "").encode()))

    return documents.withColumn(flag, score(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).where(F.col(flag) >= least).drop(flag)


