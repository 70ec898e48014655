"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer maps words to classes: insult, threat, target, negation
and reported speech.  Its fixed arcs are the small lists below; its insult
arcs (whole words, or word beginnings written ``abcd*``) carry log-odds
weights learned from labels.  Five transducers with states and arcs of their
own follow it: negation, report and target mark what they have seen in the
clause (text up to ``. ! ? ;`` or a line end), insult and threat hold the
weights of their words and at its end emit them as one of ``EMITS``.  They are
composed once into one machine (``GRAMMAR``).  Target and reporting verb count
anywhere in the clause, a negation for the words after it.  The document's
score is a logistic function of the summed clause matches.

One insult without a target is no match, whatever the labels say: in ``insult``
only what comes on top of the strongest such word counts.

Learning uses at most ``TRAIN_DOCUMENTS`` labelled rows (never held-out ones);
an arc needs several different preceding words, so that one copied passage
cannot create it, and every arc with enough evidence is kept.  Scoring reads
whole texts.

Edge cases: null, empty and match-free texts get the score of no match; very
long texts are read whole; repeated rows score alike; without labels the fixed
lists and default weights score alone; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

from .common import add_columns, keep_rows, labelled_sample

TRAIN_DOCUMENTS = 20_000
#: Different preceding words that an arc needs.
MIN_CONTEXTS = 3
THRESHOLD = 0.3
PREFIXES = (3, 4, 5, 6, 7)

# Word lists of the grammar.
INSULTS = "idiot moron loser scum stupid pathetic worthless clown trash disgusting imbecile bastard".split()
THREATS = "kill hurt stab shoot strangle beat destroy töten umbringen tuer frapper matar golpear".split()
TARGETS = "you your yours he she they them people du dich ihr euch sie tu toi vous te vosotros usted ellos".split()
NEGATIONS = "not no never nobody none isn't aren't don't niemand personne nadie nicht kein keine niemals jamais nunca".split()
REPORTS = "said says wrote claimed quoted reported sagte schrieb behauptete dit écrit dijo escribió".split()

EMITS = ("insult", "insult_target", "insult_negated", "insult_reported", "threat_target")
#: Weights of EMITS and, first, of no match, before calibration; one direct insult or threat passes THRESHOLD.
PRIOR = np.array([-3.0, 4.0, 4.5, 1.0, 1.0, 4.0])

WORD = re.compile(r"[^\W\d_]+(?:'[a-z]+)?|[.!?;\n]")
PLAIN = re.compile(r"[^\W\d_]+")
ENDS = frozenset(".!?;\n")

#: What the lexical transducer writes: classes of words, and the end of a clause.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = CLASSES = range(7)
#: Words after a negation that it holds for.
NEGATION_REACH = 3
#: What insult and threat hold until the clause ends.
PLAIN_INSULT, NEGATED_INSULT, HELD_THREAT = REGISTERS = range(3)


class Transducer(NamedTuple):
    """Arcs (state, input) -> (next state, output) of the states that ``start`` reaches."""

    start: object
    arcs: dict

    def inputs(self) -> set:
        return {x for _, x in self.arcs}

    def outputs(self) -> set:
        return {out for _, out in self.arcs.values()}


def explore(start: object, inputs: Iterable, step: Callable) -> Transducer:
    """The transducer whose arcs ``step(state, input)`` gives."""
    arcs, todo, inputs = {}, [start], list(inputs)
    seen = {start}
    while todo:
        state = todo.pop()
        for x in inputs:
            arcs[state, x] = step(state, x)
            if arcs[state, x][0] not in seen:
                seen.add(arcs[state, x][0])
                todo.append(arcs[state, x][0])
    return Transducer(start, arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One transducer that writes what ``second`` writes when it reads what ``first`` writes."""
    def step(state: tuple, x: object) -> tuple:
        a, between = first.arcs[state[0], x]
        b, out = second.arcs[state[1], between]
        return (a, b), out
    return explore((first.start, second.start), first.inputs(), step)


def negation(n: int, kind: int) -> tuple:
    """State: words for which a negation still holds.  Writes (class, negated)."""
    after = 0 if kind == END else NEGATION_REACH if kind == NEGATION else max(0, n - 1)
    return after, (kind, n > 0)


def report(seen: bool, x: tuple) -> tuple:
    """State: whether the clause had a reporting verb.  Adds it to the input."""
    return x[0] != END and (seen or x[0] == REPORT), (*x, seen)


def target(seen: int, x: tuple) -> tuple:
    """State: no target, a negated one (1), a plain one (2).  Adds it to the input."""
    kind, negated, _ = x
    return 0 if kind == END else max(seen, 2 - negated) if kind == TARGET else seen, (*x, seen)


def insult(held: tuple, x: tuple) -> tuple:
    """State: whether plain and negated insults are held.  Adds actions (register, what it is emitted as, None: hold the word)."""
    kind, negated, reported, aimed = x
    if kind == INSULT:
        return (held[0] or not negated, held[1] or negated), (*x, ((NEGATED_INSULT if negated else PLAIN_INSULT, None),))
    if kind != END:
        return held, (*x, ())
    kinds = ("insult_reported",) * 2 if reported else ("insult_target" if aimed else "insult", "insult_negated")
    return (False, False), (*x, tuple((r, EMITS.index(k)) for r, k, h in zip((PLAIN_INSULT, NEGATED_INSULT), kinds, held) if h))


def threat(held: bool, x: tuple) -> tuple:
    """State: whether threats are held.  Writes all actions; a threat without a plain target, or reported, is dropped."""
    kind, negated, reported, aimed, actions = x
    if kind == THREAT and not negated:
        return True, (*actions, (HELD_THREAT, None))
    if kind != END:
        return held, actions
    return False, (*actions, (HELD_THREAT, EMITS.index("threat_target"))) if held and aimed == 2 and not reported else actions


def chained(steps: Iterable[tuple[object, Callable]], inputs: Iterable) -> list[Transducer]:
    """Transducers of which each reads what the one before it writes."""
    out: list[Transducer] = []
    for start, step in steps:
        out.append(explore(start, inputs, step))
        inputs = out[-1].outputs()
    return out


MACHINES = chained([(0, negation), (False, report), (0, target), ((False, False), insult), (False, threat)], CLASSES)
GRAMMAR = reduce(compose, MACHINES)


def numbered(machine: Transducer) -> list[list[tuple[int, tuple]]]:
    """The arcs as rows of states, from 0, by class."""
    states = {machine.start: 0}
    for state, _ in machine.arcs:
        states.setdefault(state, len(states))
    return [[(states[new], out) for new, out in (machine.arcs[state, k] for k in CLASSES)] for state in states]


class Grammar:
    """Lexical arcs and emission weights; ``features`` runs the composed machine over a text."""

    table = numbered(GRAMMAR)

    def __init__(self, arcs: dict[str, float], weights: np.ndarray, seeds: Iterable[str] = INSULTS):
        self.arcs, self.weights = arcs, weights
        self.words = {w: 1.0 for w in seeds} | {w: v for w, v in arcs.items() if w[-1] != "*"}
        self.starts = {w[:-1]: v for w, v in arcs.items() if w[-1] == "*"}
        self.sizes = sorted({len(w) for w in self.starts})
        self.classes = {w: k for k, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (END, ENDS)) for w in words}
        self.quick = frozenset(self.words) | frozenset(THREATS)

    def insult(self, word: str) -> float:
        """Weight of the strongest insult arc that accepts the word; 0 without one."""
        best = self.words.get(word, 0.0)
        for n in self.sizes:
            if len(word) > n:
                best = max(best, self.starts.get(word[:n], 0.0))
        return best

    def features(self, text: str) -> list[float]:
        """Summed weights of the matches by kind, damped by log(1 + x)."""
        out = [0.0] * len(EMITS)
        low = text.lower()
        words = set(PLAIN.findall(low))
        if not (words & self.quick or any({w[:n] for w in words if len(w) > n} & self.starts.keys() for n in self.sizes)):
            return out
        state, lone = 0, 0.0
        held: list[list[float]] = [[] for _ in REGISTERS]
        for token in chain(WORD.findall(low), "."):
            weight, kind = 1.0, self.classes.get(token, OTHER)
            if kind == OTHER and (weight := self.insult(token)):
                kind = INSULT
            state, actions = self.table[state][kind]
            for register, emit in actions:
                if emit is None:
                    held[register].append(weight)
                    continue
                out[emit] += sum(held[register])
                if emit == 0:
                    lone = max(lone, *held[register])
            if kind == END and any(held):
                held = [[] for _ in REGISTERS]
        out[0] -= lone
        return [math.log1p(max(0.0, x)) for x in out]

    def score(self, text: str) -> float:
        z = self.weights[0] + float(np.dot(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _arc_counts(text: str) -> set[tuple[str, str]]:
    """(arc, word before) of a text."""
    out, before = set(), ""
    for w in PLAIN.findall(text.lower()):
        out.add((w, before))
        for n in PREFIXES:
            if len(w) > n:
                out.add((w[:n] + "*", before))
        before = w
    return out


def learn_arcs(sample: DataFrame) -> dict[str, float]:
    """Insult arcs with log-odds weights from the labelled sample.

    Contexts (different words before) are counted in toxic and in clean texts
    alike; an arc stays if toxic contexts outweigh clean ones by more than the
    number of arcs tried would give by chance.
    """
    def start():
        def run(texts: list[str]) -> dict:
            got = [_arc_counts(t) for t in texts]
            return {"arc": [[a for a, _ in x] for x in got], "before": [[b for _, b in x] for x in got]}
        return run

    seen = (add_columns(sample, ["y"], start, "arc array<string>, before array<string>", rows=16)
            .select("y", F.explode(F.arrays_zip("arc", "before")).alias("p")).select("y", "p.arc", F.xxhash64("p.before").alias("b")))
    toxic = (seen.where("y = 1").groupBy("arc").agg(F.approx_count_distinct("b", 0.02).alias("contexts"))
             .where(F.col("contexts") >= MIN_CONTEXTS))
    clean = seen.where("y = 0").groupBy("arc").agg(F.count(F.lit(1)).alias("n0"))
    sums = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.sum(F.length("text")).alias("n")).collect()}
    if not sums.get(1) or not sums.get(0):
        return {}
    share = sums[1] / (sums[0] + sums[1])
    # contexts, not occurrences, are the evidence
    found = materialize(toxic.join(clean, "arc", "left").select("arc", "contexts", F.coalesce("n0", F.lit(0)).alias("n0")).where("contexts > 9 * n0"), "toxic-arcs")
    need = needed(found.count())
    n, c = F.col("contexts"), F.col("n0")
    gain = n * F.log(n / (n + c) / share) + F.when(c > 0, c * F.log(c / (n + c) / (1 - share))).otherwise(0)
    rows = found.where((n / (n + c) > share) & (gain > need - 0.01)).collect()  # what can pass ``choose_arcs``
    return choose_arcs([(r["arc"], r["contexts"], r["n0"]) for r in rows], share, need)


def needed(tried: int) -> float:
    """Evidence that an arc needs where so many were tried."""
    return math.log(max(1000, 20 * tried)) + 1


def choose_arcs(found: list[tuple[str, int, int]], share: float, need: float) -> dict[str, float]:
    """Arcs (arc, toxic contexts, clean ones) whose evidence reaches ``need``, with weights.

    Words come first; a word beginning stays only for the contexts that no
    chosen longer arc explains, so that one word does not bring in all that begin like it.
    """
    out: dict[str, float] = {}
    explained: dict[str, int] = {}
    for arc, n, c in sorted(found, key=lambda x: (x[0][-1] == "*", -len(x[0]) if x[0][-1] == "*" else 0, -x[1], x[0])):
        n -= explained.get(arc, 0)
        if n <= 0:
            continue
        p = n / (n + c)
        gain = n * math.log(p / share) + (c * math.log((1 - p) / (1 - share)) if c else 0)
        if p > share and gain >= need:
            out[arc] = 1.0 + min(1.0, gain / 100)
            for k in PREFIXES:
                if k < len(arc.rstrip("*")):
                    explained[arc[:k] + "*"] = explained.get(arc[:k] + "*", 0) + n
    return out


def calibrate(x: np.ndarray, y: np.ndarray, pull: float = 1.0, steps: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps, pulled towards ``PRIOR``.

    For threats the pull is on the score of a single match, not on the weight:
    where the labelled rows hold no threat, one match keeps that score however
    far the weight of no match moves.
    """
    w = PRIOR.copy()
    pulled = np.eye(len(w))
    pulled[-1, 0] = 1 / math.log(2)
    pulled = pull * pulled.T @ pulled
    if not len(y):
        return w
    x = np.hstack([np.ones((len(x), 1)), x])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - pulled @ (w - PRIOR)
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pulled, grad)
    return w


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS, seeds: Iterable[str] = INSULTS) -> Grammar:
    """A grammar with learned arcs and calibrated weights; ``seeds`` are the insults that it knows beforehand."""
    sample = labelled_sample(docs, labels, "toxic", limit)
    grammar = Grammar(learn_arcs(sample), PRIOR, seeds)

    def start():
        return lambda texts: {"f": [grammar.features(t) for t in texts]}

    rows = add_columns(sample, ["doc_id", "y"], start, "f array<double>").drop("doc_id").collect()
    grammar.weights = calibrate(np.array([r["f"] for r in rows]).reshape(-1, len(EMITS)), np.array([r["y"] for r in rows], dtype=float))
    return grammar


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, score, predicted of every row."""
    def start():
        return lambda texts: {"score": [grammar.score(t) for t in texts]}

    return add_columns(docs, ["doc_id"], start, "score double").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def filter_documents(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    def start():
        return lambda texts: [grammar.score(t) < THRESHOLD for t in texts]

    return keep_rows(docs, start)
