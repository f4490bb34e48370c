"""Toxicity: a weighted finite-state grammar over clauses, its insult words and weights learned from labels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.arrays import slices, words_of
from coverlake.llm.text import materialise, unused

FOLDS = 4
TEST_FOLD = 2
#: At most so many labelled documents are learned from, the first by hash of their id.
SAMPLE_ROWS = 8000
#: At most so many learned words and word beginnings make up the insult lexicon, the surest first.
LEXICON_SIZE = 5000
#: Least log-likelihood ratio with the label for a learned entry.
LEAST_EVIDENCE = 20.0
BEGINNINGS = (3, 4, 5, 6)
SEED_WEIGHT = 4.0
THRESHOLD = 0.3

# The grammar's closed word classes, in English, German, French and Spanish.
INSULTS = frozenset(
    "idiot idiots moron morons imbecile stupid dumb loser losers scum trash worthless pathetic disgusting clown clowns "
    "bastard bitch jerk creep freak dummkopf trottel arschloch idiotin abschaum connard salaud imbécile crétin débile "
    "ordure idiota imbécil estúpido basura payaso cabrón".split()
)
THREATS = frozenset(
    "kill hurt destroy murder beat stab shoot punish crush smash töten umbringen schlagen vernichten tuer frapper "
    "détruire écraser matar golpear destruir aplastar".split()
)
TARGETS = frozenset(
    "you your yours yourself u he she him her they them du dich dir dein deine ihr euch sie ihn tu toi te vous votre "
    "ton ta lui tú ti usted ustedes vosotros ellos".split()
)
NEGATIONS = frozenset(
    "not no never nor neither without isn't aren't wasn't don't nicht kein keine nie niemals ne pas jamais aucun no "
    "nunca tampoco ni".split()
)
REPORTS = frozenset(
    "said says called calls wrote writes claimed quoted reported according sagte sagt nannte schrieb laut dit disait "
    "appelé écrit selon dijo dice llamó escribió según".split()
)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = TAGS = range(6)
#: How many words a negation, a target or a threat looks ahead.
REACH = 3


@dataclass(frozen=True)
class Transducer:
    """Reads tags and writes marks. `arcs[state][tag]` is (next state, marks); a tag without an arc takes `other`."""

    arcs: tuple[dict, ...]

    def step(self, state: int, tag: int) -> tuple[int, frozenset]:
        arcs = self.arcs[state]
        return arcs.get(tag) or arcs[OTHER]


def near(opens: int, fires: int, mark: str) -> Transducer:
    """Marks a `fires` tag that comes at most REACH words after an `opens` tag."""
    none = frozenset()
    states = [{OTHER: (0, none), opens: (REACH, none)}]
    for left in range(1, REACH + 1):
        states.append({OTHER: (left - 1, none), fires: (left - 1, frozenset({mark})), opens: (REACH, none)})
    return Transducer(tuple(states))


def after(opens: int, fires: int, mark: str) -> Transducer:
    """Marks every `fires` tag after an `opens` tag of the same clause."""
    none = frozenset()
    return Transducer(({OTHER: (0, none), opens: (1, none)}, {OTHER: (1, none), fires: (1, frozenset({mark}))}))


def single(fires: int, mark: str) -> Transducer:
    return Transducer(({OTHER: (0, frozenset()), fires: (0, frozenset({mark}))},))


def unexcused(opens: int, fires: int, mark: str) -> Transducer:
    """Marks a `fires` tag at most REACH words after an `opens` tag that was neither negated nor reported itself.

    A state holds how far the last negation and the last such tag still reach, and whether a report has been read.
    """
    states, arcs = [(0, 0, False)], []
    for negation, left, reported in states:  # grows as states are reached
        row = {}
        for tag in TAGS:
            counts = tag == opens and not negation and not reported
            nxt = (
                REACH if tag == NEGATION else max(negation - 1, 0),
                REACH if counts else max(left - 1, 0),
                reported or tag == REPORT,
            )
            if nxt not in states:
                states.append(nxt)
            row[tag] = (states.index(nxt), frozenset({mark}) if tag == fires and left else frozenset())
        arcs.append(row)
    return Transducer(tuple(arcs))


def compose(parts: list[Transducer]) -> Transducer:
    """The transducers run side by side, as one with a state for each reachable tuple of theirs and all their marks."""
    index, arcs, todo = {(0,) * len(parts): 0}, [], [(0,) * len(parts)]
    while todo:
        states = todo.pop(0)
        row = {}
        for tag in TAGS:
            steps = [p.step(s, tag) for p, s in zip(parts, states)]
            nxt = tuple(s for s, _ in steps)
            if nxt not in index:
                index[nxt] = len(index)
                todo.append(nxt)
            row[tag] = (index[nxt], frozenset().union(*(m for _, m in steps)))
        arcs.append(row)
    return Transducer(tuple(arcs))


GRAMMAR = compose(
    [
        single(INSULT, "insult"),
        near(TARGET, INSULT, "aimed"),
        near(NEGATION, INSULT, "excused"),
        after(REPORT, INSULT, "excused"),
        unexcused(INSULT, TARGET, "aimed_after"),
        unexcused(THREAT, TARGET, "threat"),
    ]
)
#: Log-weights of the plain features before any label is seen, and how firmly they are held.
PRIOR = np.array([-4.0, 1.5, 0.5, 0.3, 1.0, 0.5])
FIRMNESS = np.array([0.01, 1.0, 1.0, 1.0, 1.0, 1.0])


def clause_score(tags: list[int], weights: list[float]) -> np.ndarray:
    """What the grammar finds in one clause: weight of plain, aimed and excused insults, and of threats.

    An insult is excused if it is negated or reported; it is aimed if a target stands before it or, unless excused,
    after it. A threat counts at its target, unless the threat word was negated or reported.
    """
    out, state, last = np.zeros(4), 0, 0.0
    for tag, weight in zip(tags, weights):
        state, marks = GRAMMAR.step(state, tag)
        if "insult" in marks and "excused" in marks:
            out[2] += weight
        elif "insult" in marks:
            last = weight
            out[0] += weight
            if "aimed" in marks:
                out[1] += weight
        if "aimed_after" in marks:
            out[1] += last
        if "threat" in marks:
            out[3] += SEED_WEIGHT
    return out


@dataclass
class Model:
    """Learned insult words and word beginnings with their weights, and the weights of the clause features."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=PRIOR.copy)

    def tag(self, token: str) -> tuple[int, float]:
        """The first class that a part of the token belongs to; insults weigh as their surest entry."""
        for word in re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", token.lower()):
            found = max(
                self.words.get(word, 0.0),
                SEED_WEIGHT if word in INSULTS else 0.0,
                *(self.beginnings.get(word[:n], 0.0) for n in BEGINNINGS),
            )
            if found:
                return INSULT, found
            for tag, members in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
                if word in members:
                    return tag, 0.0
        return OTHER, 0.0

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


def features_of(texts: pa.Array, model: Model) -> np.ndarray:
    """One row a text: 1, log weight of plain, aimed and excused insults and threats, and insults a hundred words."""
    flat, lengths = words_of(pc.replace_substring(pc.fill_null(texts, ""), "\n", " . "))
    out = np.zeros((len(lengths), 6))
    out[:, 0] = 1
    if len(flat):
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        tagged = [model.tag(t) for t in distinct]
        tags = np.array([t for t, _ in tagged])[coded.indices.to_numpy()]
        weights = np.array([w for _, w in tagged])[coded.indices.to_numpy()]
        ends = np.array([t[-1] in '.!?;:"»”' for t in distinct])[coded.indices.to_numpy()]
        clause = np.concatenate([[0], np.cumsum(ends)[:-1]])
        text = np.repeat(np.arange(len(lengths)), lengths)
        found = np.zeros((len(lengths), 4))
        hits = np.flatnonzero((tags == INSULT) | (tags == THREAT))
        clauses = np.unique(np.stack([text[hits], clause[hits]]), axis=1).T if len(hits) else []
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        for t, c in clauses:
            low = max(int(np.searchsorted(clause, c)), int(bounds[t]))
            high = min(int(np.searchsorted(clause, c, side="right")), int(bounds[t + 1]))
            found[t] += clause_score(tags[low:high].tolist(), weights[low:high].tolist())
        out[:, 1:5] = np.log1p(found)
        out[:, 5] = np.log1p(100 * found[:, 0] / np.maximum(lengths, 1))
    return out


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and how many other texts hold each word and each word beginning, slice by slice."""
    for batch in batches:
        for part in slices(batch, "text"):
            flat, lengths = words_of(part.column("text"))
            coded = flat.dictionary_encode()
            entries: dict[str, int] = {}
            pairs = []
            for code, token in enumerate(coded.dictionary.to_pylist()):
                for word in re.findall(r"[^\W\d_]+", token.lower()):
                    for entry in (f"={word}", *(word[:n] for n in BEGINNINGS if len(word) > n)):
                        pairs.append((code, entries.setdefault(entry, len(entries))))
            if not pairs:
                continue
            of_code = np.array(pairs)
            order = np.argsort(of_code[:, 0], kind="stable")
            of_code = of_code[order]
            text = np.repeat(np.arange(len(lengths)), lengths)
            seen = np.unique(text * np.int64(len(coded.dictionary)) + coded.indices.to_numpy())
            text, code = np.divmod(seen, len(coded.dictionary))
            low, high = np.searchsorted(of_code[:, 0], code), np.searchsorted(of_code[:, 0], code, side="right")
            n = high - low
            place = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            held = np.unique(np.repeat(text, n) * np.int64(len(entries)) + of_code[place, 1])
            text, entry = np.divmod(held, len(entries))
            toxic = part.column("toxic").to_numpy(zero_copy_only=False)[text].astype(bool)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(entries)),
                    pa.array(np.bincount(entry[toxic], minlength=len(entries)), pa.int64()),
                    pa.array(np.bincount(entry[~toxic], minlength=len(entries)), pa.int64()),
                ],
                names=["entry", "n_toxic", "n_other"],
            )


def fit_weights(features: np.ndarray, labels: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression held near the prior weights, by Newton steps; insults never speak for a clean text."""
    weights = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (p - labels) + FIRMNESS * (weights - PRIOR)
        bend = (features * (p * (1 - p))[:, None]).T @ features + np.diag(FIRMNESS)
        step = np.linalg.solve(bend, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    weights[1:] = np.maximum(weights[1:], 0)
    return weights


def fold_sql(column: str = "doc_id") -> str:
    return f"crc32(CAST(coalesce(CAST({column} AS STRING), '') AS BINARY)) % {FOLDS}"


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, lexicon_size: int = LEXICON_SIZE
) -> Model:
    """A model from labelled documents outside the test fold; without any, the seed words and prior weights.

    At most `sample_rows` labelled ids are used, so they may be broadcast, and one text of each, the first by its hash:
    what reaches the driver is bounded by them, however often an id is repeated. An id with several labels is toxic if
    one of them says so; null labels and null ids are left out. At most `lexicon_size` entries are learned, the surest
    first; a smaller lexicon costs recall of rare insult words and nothing else.
    """
    sample = (
        labels.where(f"toxic IS NOT NULL AND doc_id IS NOT NULL AND {fold_sql()} <> {TEST_FOLD}")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = (
        docs.selectExpr("doc_id", "coalesce(text, '') AS text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.expr("min(struct(xxhash64(text) AS h, text)).text AS text"))
    )
    texts = materialise(texts.selectExpr("CAST(toxic > 0 AS INT) AS toxic", "text"), "labelled")
    n_toxic, n_all = texts.agg(F.sum("toxic"), F.count("*")).first()
    n_toxic, n_other = n_toxic or 0, (n_all or 0) - (n_toxic or 0)
    model = Model()
    if not n_toxic or not n_other:
        return model
    table = (
        texts.mapInArrow(_entries, "entry string, n_toxic long, n_other long")
        .groupBy("entry")
        .agg(F.sum("n_toxic").alias("a"), F.sum("n_other").alias("b"))
        .where(f"a >= 3 AND a * {n_other}L > b * {n_toxic}L")
    )
    both = f"{n_toxic + n_other}.0D"
    cells = (("a", n_toxic, "(a + b)"), ("b", n_other, "(a + b)"), (f"({n_toxic} - a)", n_toxic, f"({both} - a - b)"), (f"({n_other} - b)", n_other, f"({both} - a - b)"))
    evidence = " + ".join(f"CASE WHEN {x} > 0 THEN 2 * {x} * ln({x} * {both} / ({n}.0D * {row})) ELSE 0 END" for x, n, row in cells)
    weight = f"ln((a + 0.5D) / {n_toxic + 1}.0D) - ln((b + 0.5D) / {n_other + 1}.0D)"
    learned = (
        table.selectExpr("entry", f"{evidence} AS evidence", f"{weight} AS weight")
        .where(f"evidence >= {LEAST_EVIDENCE} AND weight > 3")
        .orderBy(F.desc("evidence"), "entry")
        .limit(lexicon_size)
        .collect()
    )
    for row in learned:
        if row.entry.startswith("="):
            model.words[row.entry[1:]] = row.weight
        else:
            model.beginnings[row.entry] = row.weight

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = features_of(part.column("text"), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["toxic", "f"]
                )

    # put in order, so that the sums of the fit do not depend on the order of tasks
    rows = sorted(texts.mapInArrow(measured, "toxic int, f array<double>").collect())
    model.weights = fit_weights(np.array([r.f for r in rows]), np.array([r.toxic for r in rows], float))
    return model


def _scores(docs: DataFrame, labels: DataFrame, columns: list[str], name: str = "score") -> DataFrame:
    """The named columns of `docs`, which hold the text, and the score under a name of its own."""
    model = train(docs, labels)
    chosen = docs.select(*columns)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score = pa.array(model.probability(features_of(part.column("text"), model)))
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=[*columns, name])

    return chosen.mapInArrow(scored, f"{types}, `{name}` double")


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Each text's probability of being toxic: doc_id, held_out, score, predicted.

    Words are tagged as insult, threat, target, negation or report; per clause the composed transducers decide which
    insults and threats are aimed, negated or reported, and a logistic regression over the sums of these matches gives
    the score. Insult words and word beginnings of any language are learned from the labels. Null and empty texts get
    the score of a text without matches; every row is scored, repeated ones alike; other columns are ignored.
    """
    return _scores(docs, labels, ["doc_id", "text"]).selectExpr(
        "doc_id",
        f"{fold_sql()} = {TEST_FOLD} AS held_out",
        "score",
        f"CAST(score >= {threshold} AS INT) AS predicted",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the rows whose score reaches the threshold; the text passes through the scoring task."""
    (name,) = unused(docs, "score")
    return _scores(docs, labels, docs.columns, name).where(f"{name} < {threshold}").drop(name)
