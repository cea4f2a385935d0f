"""Toxicity of documents by a weighted grammar of finite-state transducers over clauses.

Five transducers are composed. Two read the words of a clause: the insult machine puts out an insult where
one of its word sequences ends ("waste of space", or a single insulting word), the threat machine a threat
("i will hurt you", or a single violent verb); an announced threat to somebody is targeted by itself. Three
rewrite what these put out: negation marks the insults and threats in its reach, reported speech
those up to the end of the clause, and a target those near it on either side. A clause counts
by its strongest match of each core and status, however many words match in it; clauses are
weighed by mark, added up per document, and turned into a score by a logistic function. So "you are
not an idiot" and "she said he is an idiot" count less than "you idiot".

Seed words are fixed values; further insults, and the weights, are learned from labelled
rows: a bounded sample of SAMPLE_PER_CLASS rows a class. A learned word must be frequent in toxic
documents, rare in others, and follow many different words, so that a passage that is copied
between toxic documents teaches nothing. All such words of the sample are taken, so its bound is theirs.

Null and empty texts have the score of a document without matches, below 0.5. Labels that are
null, repeated or without a document are ignored; without any labels the prior weights hold. Texts
of any length are scored whole. Other columns are neither read nor changed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entity360.llm.common import column, crc_bucket, written

SAMPLE_PER_CLASS = 4_000
MIN_TOXIC_DOCS, MIN_CONTEXTS, CONTEXT_SHARE = 5, 4, 0.25
FOLDS, HELD_OUT = 5, 0

# Seed words of the grammar.
INSULTS = (
    "asshole bastard bitch clown coward cretin dimwit disgusting dumbass garbage halfwit "
    "idiot idiota idiotic idioten imbecile imbécile imbécil jackass loser losers moron morons "
    "nitwit pathetic scum scumbag stupid stupido estúpido subhuman trash trottel vermin "
    "worthless arschloch dummkopf abschaum connard ordure basura asqueroso"
).split()
THREATS = (
    "kill murder strangle strangling slaughter stab shoot destroy butcher exterminate töten "
    "umbringen matar asesinar tuer assassiner"
).split()
TARGETS = (
    "you your you're youre yourself yourselves u he she they them him her his their these those "
    "people du dich dir ihr euch sie tu te toi vous ton tú usted ustedes eres"
).split()
NEGATIONS = (
    "not no never isn't aren't wasn't don't doesn't didn't won't nobody without neither nor "
    "nicht kein keine nie pas jamais nunca jamás"
).split()
REPORTS = (
    "said says say told tells claimed claims wrote writes called quoted quote reported alleged "
    "allegedly according shouted sagte dit disait dijo"
).split() + ['"', "“", "”", "«", "»"]

FIRST_PERSONS = "i i'm im we ich wir je j nous yo".split()
INTENTS = "will shall gonna werde werden vais allons voy".split()
# Word sequences; in capitals a class of words, its core included.
INSULT_PHRASES = (
    "INSULT",
    "waste of space",
    "waste of oxygen",
    "waste of skin",
    "piece of shit",
    "sack of shit",
    "go to hell",
    "drop dead",
    "shut your mouth",
    "leck mich",
    "halt die klappe",
    "halt die fresse",
    "ferme ta gueule",
    "ta gueule",
    "fils de pute",
    "hijo de puta",
    "vete al infierno",
    "cállate la boca",
)
THREAT_PHRASES = ("THREAT", "deserve to die", "deserves to die")
ANNOUNCED_PHRASES = (
    "FIRST INTENT THREAT TARGET",
    "FIRST INTENT TARGET THREAT",
    "FIRST going to THREAT TARGET",
    "i'll THREAT TARGET",
    "FIRST INTENT hurt TARGET",
    "FIRST going to hurt TARGET",
    "i'll hurt TARGET",
    "TARGET are going to die",
    "you'll die",
)

CORES = ("insult", "threat")
MARKS = "nrt"  # negated, reported, targeted
STATUS = ("plain", "targeted", "reported", "negated")
#: Prior weights of (core, status), then the bias.
PRIOR = np.array([2.2, 2.8, 0.6, 0.4, 0.4, 3.0, 0.6, 0.3, -2.0])

_CLAUSE_END = re.compile(r"[.!?;\n\r]")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[\"“”«»]")

Symbol = str
State = tuple[int, ...]


def marked(core: str, marks: Iterable[str]) -> Symbol:
    """A core with its marks, in the order of MARKS."""
    return core + "".join(f"+{m}" for m in MARKS if m in set(marks))


def alphabet() -> list[Symbol]:
    subsets = [[m for i, m in enumerate(MARKS) if k >> i & 1] for k in range(1 << len(MARKS))]
    return ["other", "negation", "report", "target"] + [
        marked(c, s) for c in CORES for s in subsets
    ]


@dataclass(frozen=True)
class Transducer:
    """Arcs from (state, symbol) to (next state, symbol put out)."""

    start: State
    arcs: dict[tuple[State, Symbol], tuple[State, Symbol]]

    def run(self, symbols: Iterable[Symbol]) -> list[Symbol]:
        state, out = self.start, []
        for symbol in symbols:
            state, put = self.arcs[state, symbol]
            out.append(put)
        return out


def scope(trigger: Symbol, mark: str, reach: int | None) -> Transducer:
    """Marks insults and threats within `reach` symbols after a trigger (None: to the end)."""
    arcs = {}
    for left in range((reach or 1) + 1):
        for symbol in alphabet():
            after = left if reach is None else max(0, left - 1)
            if symbol == trigger:
                arcs[(left,), symbol] = (reach or 1,), symbol
            elif left and symbol.startswith(CORES):
                core, *marks = symbol.split("+")
                arcs[(left,), symbol] = (after,), marked(core, [*marks, mark])
            else:
                arcs[(left,), symbol] = (after,), symbol
    return Transducer((0,), arcs)


def phrases(found: dict[tuple[Symbol, ...], Symbol], symbols: Iterable[Symbol]) -> Transducer:
    """Puts out a symbol where a sequence ends, the longest one if several do; all else passes.

    A state is the longest end of what was read that a sequence starts with.
    """
    symbols = list(symbols)
    starts = sorted({seq[:k] for seq in found for k in range(len(seq) + 1)})
    number = {prefix: k for k, prefix in enumerate(starts)}
    arcs = {}
    for prefix, state in number.items():
        for symbol in symbols:
            read = (*prefix, symbol)
            ends = [read[k:] for k in range(len(read) + 1)]
            after = next(number[e] for e in ends if e in number)
            arcs[(state,), symbol] = (after,), next((found[e] for e in ends if e in found), symbol)
    return Transducer((number[()],), arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds what `first` puts out to `second`."""
    symbols = {symbol for _, symbol in first.arcs}
    start = first.start + second.start
    arcs, open_states, seen = {}, [(first.start, second.start)], {(first.start, second.start)}
    while open_states:
        a, b = open_states.pop()
        for symbol in symbols:
            next_a, between = first.arcs[a, symbol]
            next_b, put = second.arcs[b, between]
            arcs[a + b, symbol] = next_a + next_b, put
            if (next_a, next_b) not in seen:
                seen.add((next_a, next_b))
                open_states.append((next_a, next_b))
    return Transducer(start, arcs)


CLASS_OF = (
    dict.fromkeys(FIRST_PERSONS, "first")
    | dict.fromkeys(INTENTS, "intent")
    | dict.fromkeys(TARGETS, "target")
    | dict.fromkeys(NEGATIONS, "negation")
    | dict.fromkeys(REPORTS, "report")
    | dict.fromkeys(THREATS, "threat")
)


def _sequence(phrase: str) -> tuple[Symbol, ...]:
    """Its symbols: a class in capitals or of a word, else the word itself with a sign before it."""
    return tuple(w.lower() if w.isupper() else CLASS_OF.get(w, f"={w}") for w in phrase.split())


def phrase_words() -> set[str]:
    """The words without a class that the sequences name."""
    listed = (*INSULT_PHRASES, *THREAT_PHRASES, *ANNOUNCED_PHRASES)
    return {symbol[1:] for phrase in listed for symbol in _sequence(phrase) if symbol[0] == "="}


@cache
def cores() -> Transducer:
    """Insult and threat machine composed: from words to insults, threats and the symbols around them."""
    words = {f"={w}" for w in phrase_words()}
    known = {*alphabet(), "first", "intent", *words}
    insult = phrases(dict.fromkeys(map(_sequence, INSULT_PHRASES), "insult"), known)
    announced = dict.fromkeys(map(_sequence, ANNOUNCED_PHRASES), marked("threat", "t"))
    threat = phrases(dict.fromkeys(map(_sequence, THREAT_PHRASES), "threat") | announced, known)
    rest = {s: s if s in alphabet() else "other" for s in known}
    plain = Transducer((0,), {((0,), s): ((0,), put) for s, put in rest.items()})
    return compose(compose(insult, threat), plain)


@cache
def grammar() -> tuple[Transducer, Transducer]:
    """The machine for cores read forwards, and the one for targets after the insult."""
    target = scope("target", "t", 3)
    forwards = compose(compose(scope("negation", "n", 4), scope("report", "r", None)), target)
    return forwards, target


@dataclass
class Model:
    """Words with their weights, and the weights of what the grammar puts out."""

    insults: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 1.0))
    weights: np.ndarray = field(default_factory=PRIOR.copy)

    @cached_property
    def symbols(self) -> dict[str, Symbol]:
        return (
            {w: f"={w}" for w in phrase_words()}
            | CLASS_OF
            | dict.fromkeys(self.insults, "insult")
        )

    @cached_property
    def finder(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        listed = (*INSULT_PHRASES, *THREAT_PHRASES, *ANNOUNCED_PHRASES)
        anchors = {max((w for w in p.split() if not w.isupper()), key=len, default="") for p in listed} - {""}
        for word in {*self.insults, *THREATS, *anchors}:
            found.add_word(word, len(word))
        found.make_automaton()
        return found

    def __getstate__(self) -> dict:
        return {"insults": self.insults, "weights": self.weights}

    def clauses(self, text: str) -> Iterator[str]:
        """The clauses that may hold an insult or a threat, each once: those with a word that each needs."""
        done = 0
        for end, length in self.finder.iter(text):
            start = end - length + 1
            if start < done or text[start - 1 : start].isalnum() or text[end + 1 : end + 2].isalnum():
                continue
            stop = _CLAUSE_END.search(text, end + 1)
            done = stop.start() if stop else len(text)
            begin = max(text.rfind(c, 0, start) for c in ".!?;\n\r") + 1
            yield text[begin:done]

    def features(self, text: str | None) -> np.ndarray:
        """Weight of the matched clauses by core and status, on a log scale."""
        sums = np.zeros(len(CORES) * len(STATUS))
        forwards, target = grammar()
        for clause in self.clauses((text or "").lower()):
            words = _WORD.findall(clause)
            put = forwards.run(cores().run(self.symbols.get(w, "other") for w in words))
            put = target.run(put[::-1])[::-1]
            strongest = np.zeros_like(sums)
            for word, symbol in zip(words, put, strict=True):
                core, *marks = symbol.split("+")
                if core in CORES:
                    status = 3 if "n" in marks else 2 if "r" in marks else 1 if "t" in marks else 0
                    at = CORES.index(core) * len(STATUS) + status
                    strongest[at] = max(strongest[at], self.insults.get(word, 1.0))
            sums += strongest
        return np.log1p(sums)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features @ self.weights[:-1] + self.weights[-1])))


def fit_weights(features: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Logistic regression by Newton steps around PRIOR.

    share: toxic rows among all labelled ones; the sample's rows are weighed so that it holds.
    """
    if not len(toxic) or toxic.min() == toxic.max():
        return PRIOR.copy()
    x = np.hstack([features, np.ones((len(features), 1))])
    sampled = toxic.mean()
    rows = np.where(toxic == 1, share / sampled, (1 - share) / (1 - sampled))
    rows *= min(1.0, 2_000 / len(toxic))  # a sample of any size moves the prior as 2,000 rows do
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (rows * (p - toxic)) + (w - PRIOR)
        hessian = (x * (rows * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _words_with_neighbours(texts: DataFrame) -> DataFrame:
    """One row per document and word, with the word before its first place."""
    words = F.expr(r"regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+', 0)")
    return (
        texts.select("id", "toxic", words.alias("words"))
        .select("id", "toxic", F.posexplode("words"), "words")
        .select("id", "toxic", F.col("col").alias("word"), F.expr("get(words, pos - 1)").alias("before"))
        .groupBy("id", "toxic", "word")
        .agg(F.first("before").alias("before"))
    )


def learned_insults(texts: DataFrame) -> dict[str, float]:
    """Words of toxic documents with their weights; texts: (id, toxic, text), bounded."""
    rows = (
        _words_with_neighbours(texts)
        .where(F.length("word") >= 4)
        .groupBy("word")
        .agg(
            F.sum("toxic").alias("toxic"),
            F.sum(1 - F.col("toxic")).alias("clean"),
            F.countDistinct(F.when(F.col("toxic") == 1, F.col("before"))).alias("contexts"),
        )
        .where(
            (F.col("toxic") >= MIN_TOXIC_DOCS)
            & (F.col("toxic") >= 20 * F.col("clean"))
            & (F.col("contexts") >= MIN_CONTEXTS)
            & (F.col("contexts") >= CONTEXT_SHARE * F.col("toxic"))
        )
        .collect()
    )
    return {r.word: min(1.0, float(np.log(r.toxic / (r.clean + 0.5)) / 3)) for r in rows}


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """A model from labelled rows outside the held-out fold."""
    known = labels.select(
        column(labels, id_col).cast("long").alias("id"), column(labels, "toxic").cast("int").alias("toxic")
    ).where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.where(crc_bucket(F.col("id"), FOLDS) != HELD_OUT)
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    lot = F.xxhash64("id", F.lit(3))
    picked = [
        known.where(F.col("toxic") == k).orderBy(lot, "id").limit(SAMPLE_PER_CLASS) for k in (0, 1)
    ]
    # At most 2 * SAMPLE_PER_CLASS ids, so they are sent to all executors.
    ids = F.broadcast(picked[0].unionByName(picked[1]).dropDuplicates(["id"]))
    texts = docs.select(
        column(docs, id_col).cast("long").alias("id"), column(docs, text_col).alias("text")
    )
    sample = written(texts.join(ids, "id"), "toxic-sample")
    model = Model()
    model.insults |= learned_insults(sample)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [model.features(t) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "features": [r.tolist() for r in rows]})

    found = sample.mapInPandas(extract, "toxic int, features array<double>").collect()
    if found:
        features = np.array([r.features for r in found])
        model.weights = fit_weights(features, np.array([r.toxic for r in found]), share)
    return model


def score(model: Model, text: Column) -> Column:
    """The score of a text, 0 to 1."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        features = [model.features(t) for t in texts]
        return pd.Series(model.scores(np.array(features))) if features else pd.Series([], dtype=float)

    return scored(text)


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents whose score is below 0.5, with the columns of `docs`."""
    return docs.where(score(train(docs, labels, id_col, text_col), column(docs, text_col)) < 0.5)
