"""Toxicity: a lexicon matched through Levenshtein automata, with the context of each hit."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.shared import forget, in_parts, rows_of, written

#: Known in advance; the labels add to it.
SEEDS = tuple(
    "idiot moron loser stupid worthless pathetic disgusting trash scum clown dumbass bastard retard "
    "vermin filth scumbag imbecile degenerate".split()
)
#: Bounds of what is learned from: labelled rows, and entries of the lexicon.
MAX_LABELLED = 20_000
MAX_TERMS = 2_000
#: A term is learned if its log-likelihood ratio is at least this and most of its rows are toxic.
MIN_EVIDENCE = 30.0
MIN_PRECISION = 0.9
STEM_LENGTHS = (4, 5, 6, 7, 8)
MAX_WORD = 24
#: Terms of at least so many letters are also found with one edit.
MIN_FUZZY = 5
#: Stems, which any ending may follow, need one letter more.
MIN_FUZZY_STEM = 6
#: A hit with an edit counts as so much of a hit in context, distinct terms and share.
DISCOUNT = 0.5
WINDOW = 6
THRESHOLD = 0.3
#: Words that a task remembers the verdict of; beyond it, it starts anew.
REMEMBER = 400_000

_STRIP = ".,;:!?\"'“”„«»‹›()[]{}<>*#$%&|-_…"
_OPEN, _CLOSE = frozenset("\"“„«‹'"), frozenset("\"”“»›'")
_REPORT = frozenset("said says word words term terms called calling quote quoted quoting means meaning defined definition spelled slur insult insults report reported".split())
_ADDRESS = frozenset("you your you're youre yourself u ur tu te vous du dich dein ihr usted eres".split())

#: What letters are replaced by in altered terms.
_LOOKS = {"a": "4", "e": "3", "i": "1", "o": "0", "s": "5", "t": "7", "u": "v", "l": "1", "b": "8"}

EXACT, STEM, FUZZY = 0, 1, 2
FEATURES = ("constant", "exact", "stem", "fuzzy", "abusive", "quoted", "distinct", "share")
_PRIOR = np.array([-4.0, 2.0, 2.0, 0.5, 1.0, -1.0, 1.0, 1.0])


# --- the lexicon --------------------------------------------------------------


@dataclass
class Matcher:
    """Levenshtein automata of all terms at once, run against the trie of the lexicon.

    A state is a set of (trie node, edits left). Reading a letter either follows the trie or
    spends an edit on a letter too many, missing or wrong. States are made as words call for
    them and kept, so that most words end in the dead state after a few steps.
    A term is (text, is a stem): a stem is matched by any word that begins with it, or with
    something one edit from it.
    """

    terms: tuple[tuple[str, bool], ...]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[int | None] = field(default_factory=lambda: [None])

    def __post_init__(self) -> None:
        self.fuzzy_below: list[bool] = [False]
        for number, (text, stem) in enumerate(self.terms):
            node, path = 0, [0]
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.fuzzy_below.append(False)
                node = self.children[node][letter]
                path.append(node)
            if self.ends[node] is None or stem:
                self.ends[node] = number
            if self.edited(number):
                for at in path:
                    self.fuzzy_below[at] = True
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.near: list[tuple[int | None, int | None]] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 1)})

    def edited(self, number: int) -> bool:
        """Whether a term is also found with one edit."""
        text, stem = self.terms[number]
        return len(text) >= (MIN_FUZZY_STEM if stem else MIN_FUZZY)

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The number of a state, after adding what a missing letter leads to."""
        full = set(pairs)
        for node, left in pairs:
            if left:
                full.update((child, 0) for child in self.children[node].values() if self.fuzzy_below[child])
        full = frozenset(p for p in full if p[1] or (p[0], 1) not in full)
        if full not in self.states:
            self.states[full] = len(self.sets)
            self.sets.append(full)
            self.moves.append({})
            ends = {self.ends[n] for n, left in full if not left and self.ends[n] is not None}
            ends = [t for t in ends if self.edited(t)]
            self.near.append(tuple(min((t for t in ends if self.terms[t][1] == stem), default=None) for stem in (False, True)))
        return self.states[full]

    def _move(self, state: int, letter: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, left in self.sets[state]:
            child = self.children[node].get(letter)
            if child is not None:
                out.add((child, left))
            if left:
                if self.fuzzy_below[node]:
                    out.add((node, 0))
                out.update((c, 0) for c in self.children[node].values() if self.fuzzy_below[c])
        found = self._state(out)
        self.moves[state][letter] = found
        return found

    def find(self, word: str) -> tuple[int, int] | None:
        """(how, term) of the best match of a word: exact, then by a stem, then with one edit.

        With an edit, whole words go before stems.
        """
        state, stem, near_stem, node = self.start, None, None, 0
        exact_path = True
        for letter in word:
            if exact_path:
                node = self.children[node].get(letter, -1)
                exact_path = node >= 0
                if exact_path and self.ends[node] is not None and self.terms[self.ends[node]][1]:
                    stem = self.ends[node]
            after = self.moves[state].get(letter)
            state = self._move(state, letter) if after is None else after
            if not self.sets[state]:
                break
            if near_stem is None:
                near_stem = self.near[state][1]
        else:
            if exact_path and self.ends[node] is not None:
                return (STEM if self.terms[self.ends[node]][1] else EXACT), self.ends[node]
            if stem is None and self.near[state][0] is not None:
                return FUZZY, self.near[state][0]
        if stem is not None:
            return STEM, stem
        return None if near_stem is None else (FUZZY, near_stem)


def plain(word: str) -> str:
    return word.strip(_STRIP)


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon, weights, and the words that are an edit from a term by chance: no hits."""

    terms: tuple[tuple[str, bool], ...]
    weights: tuple[float, ...]
    chance: frozenset[str] = frozenset()


class Scorer:
    """Features and score of whole texts."""

    def __init__(self, model: ToxicityModel):
        self.matcher = Matcher(model.terms)
        self.weights = np.array(model.weights)
        self.chance = model.chance
        self.known: dict[str, tuple[int, int] | None] = {}

    def _hit(self, word: str) -> tuple[int, int] | None:
        own = plain(word)
        hit = self.matcher.find(own) if 3 < len(own) <= MAX_WORD else None
        return None if hit is not None and hit[0] == FUZZY and own in self.chance else hit

    def hits(self, words: list[str]) -> list[tuple[int, tuple[int, int]]]:
        """(place, hit) of the words that match."""
        known, hits = self.known, []
        for at, word in enumerate(words):
            try:
                hit = known[word]
            except KeyError:
                if len(known) > REMEMBER:
                    known.clear()
                hit = known[word] = self._hit(word)
            if hit is not None:
                hits.append((at, hit))
        return hits

    def features(self, text: str) -> np.ndarray:
        """What the hits of a text add up to; see ``FEATURES``.

        A hit speaks for abuse if, within six words, someone is addressed, another hit follows
        or an exclamation mark stands; it counts as quoted if quotation marks enclose it there,
        or a word of reporting stands nearby. Hits with an edit have the same contexts, and count
        ``DISCOUNT`` of a hit there, among the distinct terms and in the share.
        """
        words = text.lower().split()
        hits = self.hits(words)
        counts, abusive, quoted = [0, 0, 0], 0.0, 0.0
        for number, (at, (how, _)) in enumerate(hits):
            counts[how] += 1
            much = DISCOUNT if how == FUZZY else 1.0
            near = words[max(0, at - WINDOW) : at + WINDOW + 1]
            bare = {plain(w) for w in near}
            before = words[max(0, at - WINDOW) : at + 1]
            after = words[at : at + WINDOW + 1]
            enclosed = any(w[0] in _OPEN for w in before) and any(plain(w) != w and (w[-1] in _CLOSE or w.rstrip(".,;:!?")[-1:] in _CLOSE) for w in after)
            if enclosed or not bare.isdisjoint(_REPORT):
                quoted += much
            close = any(
                0 <= other < len(hits) and abs(hits[other][0] - at) <= WINDOW for other in (number - 1, number + 1)
            )
            if close or not bare.isdisjoint(_ADDRESS) or any("!" in w for w in near):
                abusive += much
        log = math.log1p
        share = 100.0 * (counts[EXACT] + counts[STEM] + DISCOUNT * counts[FUZZY]) / max(1, len(words))
        as_is = {term for _, (how, term) in hits if how != FUZZY}
        distinct = len(as_is) + DISCOUNT * len({term for _, (how, term) in hits if how == FUZZY} - as_is)
        return np.array(
            [1.0, log(counts[EXACT]), log(counts[STEM]), log(counts[FUZZY]), log(abusive), log(quoted), log(distinct), log(share)]
        )

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -40, 40))))


def altered(text: str, scorer: Scorer) -> str | None:
    """A text with a letter of each term dropped, doubled or replaced; None if it has no term.

    Which letter and how follow from the word and its place; the first letter stays.
    """
    words, changed = text.lower().split(), False
    for at, (how, term) in scorer.hits(words):
        found = scorer.matcher.terms[term][0]
        start = words[at].find(found)
        if how == FUZZY or start < 0 or not scorer.matcher.edited(term):
            continue
        code = zlib.crc32(f"{at} {found}".encode())
        k = start + 1 + code % (len(found) - 1)
        letter = words[at][k]
        instead = ("", letter * 2, _LOOKS.get(letter, "x"))[code // 64 % 3]
        words[at] = words[at][:k] + instead + words[at][k + 1 :]
        changed = True
    return " ".join(words) if changed else None


# --- learning ------------------------------------------------------------------


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other texts each word and stem occurs; words end in a full stop."""
    forget()
    for batch in batches:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = {w for w in map(plain, set((text or "").lower().split())) if 3 < len(w) <= MAX_WORD}
            own = {w + "." for w in words}
            for n in STEM_LENGTHS:
                own.update(w[:n] for w in words if len(w) >= n)
            found[toxic].update(own)
        keys = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([found[1][k] for k in keys], pa.int64()), pa.array([found[0][k] for k in keys], pa.int64())],
            ["term", "toxic", "clean"],
        )


def learned_terms(counted: list[tuple[str, int, int]]) -> list[tuple[str, bool]]:
    """Of nested stems and words the most widespread; at equal spread the longest."""
    taken: list[str] = []
    seen: set[str] = set()
    for term, _, _ in sorted(counted, key=lambda c: (-c[1], -len(c[0]), c[0])):
        bare = term.rstrip(".")
        inner = any(bare[:n] in seen for n in range(1, len(bare) + 1))
        outer = any(t.startswith(bare) for t in taken)
        if not inner and not outer:
            taken.append(term)
            seen.add(bare)
    return [(t.rstrip("."), not t.endswith(".")) for t in taken]


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most ``MAX_LABELLED`` labelled texts, those whose ids hash lowest; fold 2 is left out.

    A document labelled more than once is toxic if any label says so. The labels are sent to
    the texts: they are bounded.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    return docs.join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic")


def held_out(doc_id):
    """Ids of the fold that nothing is learned from; a missing id is in none."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_toxicity(rows: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Lexicon and weights from labelled rows (doc_id, text); bounded tables reach the driver."""
    train = written(training_rows(rows, labels), "labelled")
    total = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = total.get(1, 0), total.get(0, 0)
    seeds = [(t, False) for t in SEEDS]
    if not bad or not good:
        return ToxicityModel(tuple(seeds), tuple(_PRIOR.tolist()))
    counts = train.mapInArrow(_term_counts, "term string, toxic long, clean long").groupBy("term")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n, rate = F.col("toxic") + F.col("clean"), bad / (bad + good)
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    evidence = 2 * (part(F.col("toxic"), rate) + part(F.col("clean"), 1 - rate))
    kept = counts.filter((F.col("toxic") > 1) & (F.col("toxic") >= MIN_PRECISION * n)).withColumn("evidence", evidence)
    kept = kept.filter(F.col("evidence") >= MIN_EVIDENCE).orderBy(F.desc("evidence"), "term").limit(MAX_TERMS)
    found = learned_terms([(r["term"], r["toxic"], r["clean"]) for r in kept.collect()])
    terms = tuple(dict.fromkeys([*found, *[s for s in seeds if s[0] not in dict(found)]]))
    lexicon = ToxicityModel(terms, tuple(_PRIOR.tolist()))

    def near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(lexicon)
        for batch in batches:
            seen: Counter = Counter()
            for doc_id, text, toxic in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))):
                words = (text or "").lower().split()
                seen.update({(plain(words[at]), _half(doc_id), toxic) for at, (how, _) in scorer.hits(words) if how == FUZZY})
            form, half, toxic = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(form, pa.string()), pa.array(half, pa.int32()), pa.array(toxic, pa.int32()), pa.array(seen.values(), pa.int64())],
                ["form", "half", "toxic", "n"],
            )

    forms = train.mapInArrow(near_words, "form string, half int, toxic int, n long").groupBy("form")
    tables = [F.sum(F.when((F.col("half") == h) & (F.col("toxic") == y), F.col("n")).otherwise(0)) for h in (0, 1) for y in (0, 1)]
    forms = [tuple(r) for r in forms.agg(*tables).collect()]
    chance = lambda bad, good: good > 0 and bad < MIN_PRECISION * (bad + good)
    # A half's features are measured without the words known from it, as those of new texts are.
    of_half = [ToxicityModel(terms, lexicon.weights, frozenset(f[0] for f in forms if chance(f[2 + 2 * h], f[1 + 2 * h]))) for h in (1, 0)]
    known = frozenset(f[0] for f in forms if chance(f[2] + f[4], f[1] + f[3]))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorers = [Scorer(m) for m in of_half]
        for batch in batches:
            x, y = [], []
            for doc_id, text, toxic in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))):
                scorer = scorers[_half(doc_id)]
                for own in (text or "", altered(text or "", scorer)):
                    if own is not None:
                        x.append(scorer.features(own).tolist())
                        y.append(toxic)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    table = train.mapInArrow(measured, "toxic int, x array<double>").groupBy("toxic", "x").agg(F.count(F.lit(1)).alias("n"))
    seen = sorted((tuple(r["x"]), r["toxic"], r["n"]) for r in table.collect())
    x, y, weight = (np.array([s[i] for s in seen], float) for i in range(3))
    return ToxicityModel(terms, tuple(_fitted(x, y, weight).tolist()), known)


def _half(doc_id: int) -> int:
    return zlib.crc32(f"half {doc_id}".encode()) & 1


def _fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic weights near the prior ones; that of terms with an edit is not negative."""
    near, free = FEATURES.index("fuzzy"), np.ones(len(_PRIOR), bool)
    while True:
        w = np.where(free, _PRIOR, 0.0)
        own = x[:, free]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = own.T @ (weight * (p - y)) + 0.5 * (w - _PRIOR)[free]
            curve = (own * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ own + 0.5 * np.eye(own.shape[1])
            step = np.linalg.solve(curve, slope)
            w[free] -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if w[near] >= 0:
            return w
        free[near] = False


def score_toxicity(
    docs: DataFrame, labels: DataFrame | None = None, model: ToxicityModel | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; only the text enters the score.

    Null and empty texts have no hits and score as such. Ids and repeated rows pass through;
    an empty table gives no rows. Without labels, or with labels of one kind only, the seeds
    are the lexicon. Fitting looks at a bounded number of labelled rows, scoring at every row.

    Terms with one edit are weighed by fitting each labelled text also with its terms altered.
    Words that are an edit from a term by chance, as clean labelled texts have them, are no hits.
    """
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    model = model or fit_toxicity(rows, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(model)
        for batch in batches:
            score = [scorer.score(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with all their columns; null texts stay."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(model)
        for batch in in_parts(batches, at):
            yield batch.filter(pa.array([scorer.score(t.as_py() or "") < THRESHOLD for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
