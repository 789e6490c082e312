"""Toxicity: a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, object, negation, report, quote, other). Two chains of weighted
transducers read a clause, each transducer the output of the one before. The first chain reads from the clause's
end: whom a threat names after it ("kill you") makes it a menace, whom an insult names after it makes it aimed, and
a report that follows ("idiot, she said") weakens; who reports is no target. The second reads from the beginning: any pronoun before an insult
aims it, but only an object before a threat makes it a menace (as in "dich töten"; in "they beat the record" they are
the subject); a negation close before weakens, as do reported speech and quotation. Each chain is composed into one
machine, once a process. A lone insult keeps its own weight; how much weight it takes to be called toxic is learned. The score of a
text is a logistic function of its clauses' weights, never of a single word's presence.

Insults are learned: words and word beginnings that stand in many different contexts of toxic texts and
hardly any of others, from a bounded sample of the labelled rows (SAMPLE_TOXIC and SAMPLE_CLEAN, chosen by
a hash of the key), besides a short list of insults and threats that holds in any corpus. All of the sample
finds the words; the logistic function is fitted on each half with the words of the other, so no text is
measured by words that it taught itself. Texts are read whole.

Null and empty texts have no clauses and get the function's least score. Without labels the function is a
fixed one. Repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, small_batches, unit_hash, written

SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
#: Letters of a word's beginning that may be learned; terms that are kept at most.
STEMS, MAX_TERMS = (4, 5, 6), 5000
#: Terms with contexts that a worker holds before it sends them.
HELD_TERMS = 100_000
#: Different contexts that a term must be seen in, and the least evidence (a log-likelihood ratio).
MIN_CONTEXTS, MIN_EVIDENCE = 6, 30.0

INSULT, THREAT, TARGET, OBJECT, NEGATION, REPORT, QUOTE, OTHER, AIMED, MENACE = SYMBOLS = range(10)
#: The grammar's closed lists, in the languages of the corpus.
INSULTS = "idiot idiots moron morons imbecile stupid dumb scum trash loser losers pathetic worthless disgusting clown bastard bitch asshole fucker whore vermin filth retard dummkopf arschloch abschaum hurensohn schlampe connard salope enculé crétin ordure imbécile pendejo cabrón puta basura escoria estúpido idiota".split()
THREATS = "kill hurt beat destroy murder strangle töten umbringen vernichten tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your yours he she they them him her du dich dir ihr euch sie tu te toi vous ils elles usted ustedes tú ti vosotros ellos ellas".split()
#: Those of them that stand before a verb as its object; the others before it are its subject.
OBJECTS = "him them her dich dir euch te vous".split()
NEGATIONS = "not no never isn't aren't don't won't wasn't nicht kein keine nie niemals ne pas jamais nunca jamás ni".split()
REPORTS = "said says called calls quoted wrote reported claimed allegedly sagte sagt nannte schrieb angeblich disait écrit appelé dijo dice llamó escribió".split()
QUOTES = set("\"“”„«»")

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”„«»]")
_CLAUSE_END = re.compile(r"[.!?;\n]")


#: What weighs, before and after targets are read.
_WEIGHS = (INSULT, THREAT, AIMED, MENACE)


@dataclass(frozen=True)
class Transducer:
    """From state and symbol to the next state, the symbol that is written and a factor. A symbol that isn't named is written as it is and leads where rest says, or nowhere else."""

    moves: dict[tuple[int, int], tuple[int, int, float]]
    rest: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        if (move := self.moves.get((state, symbol))) is not None:
            return move
        return self.rest.get(state, state), symbol, 1.0

    def then(self, other: Transducer) -> Transducer:
        """The composition: other reads what this writes. States are those that can be reached, numbered from (0, 0)."""
        number, moves, todo = {(0, 0): 0}, {}, [(0, 0)]
        while todo:
            a, b = todo.pop()
            for symbol in SYMBOLS:
                a2, written, f = self.step(a, symbol)
                b2, out, g = other.step(b, written)
                if (a2, b2) not in number:
                    number[a2, b2] = len(number)
                    todo.append((a2, b2))
                moves[number[a, b], symbol] = number[a2, b2], out, f * g
        return Transducer(moves)


def _fading(opens: tuple[int, ...], acts: dict[int, int], words: int, factor: float) -> Transducer:
    """After a symbol that opens it, and for so many words, the factor holds for symbols, which are written as others."""
    moves = {(s, o): (words, o, 1.0) for s in range(words + 1) for o in opens}
    moves |= {(s, a): (s - 1, out, factor) for s in range(1, words + 1) for a, out in acts.items()}
    return Transducer(moves, {s: s - 1 for s in range(1, words + 1)})


#: From a clause's end: a pronoun right before a report is who speaks, no target.
_SPEAKER = Transducer({(s, REPORT): (1, REPORT, 1.0) for s in (0, 1)} | {(1, x): (0, OTHER, 1.0) for x in (TARGET, OBJECT)}, {1: 0})


def _quoted(factor: float) -> Transducer:
    inside = {(1, a): (1, a, factor) for a in _WEIGHS}
    return Transducer({(0, QUOTE): (1, QUOTE, 1.0), (1, QUOTE): (0, QUOTE, 1.0)} | inside)


#: Read one after the other, from a clause's end: what comes after insults and threats.
BACKWARD = (
    _SPEAKER,
    _fading((TARGET, OBJECT), {THREAT: MENACE}, 3, 2.0),
    _fading((TARGET, OBJECT), {INSULT: AIMED}, 2, 1.3),
    _fading((REPORT,), {x: x for x in _WEIGHS}, 3, 0.6),
)
#: Read one after the other, from its beginning: what comes before.
FORWARD = (
    _fading((TARGET, OBJECT), {INSULT: AIMED}, 6, 1.3),
    _fading((OBJECT,), {THREAT: MENACE}, 4, 2.0),
    _fading((NEGATION,), {x: x for x in _WEIGHS}, 3, 0.3),
    _fading((REPORT,), {x: x for x in _WEIGHS}, 8, 0.6),
    _quoted(0.5),
)


@cache
def machines() -> tuple[Transducer, Transducer]:
    """Either chain as one transducer."""
    return reduce(Transducer.then, BACKWARD), reduce(Transducer.then, FORWARD)


def _read(moves: dict, symbols: list[tuple[int, float]]) -> list[tuple[int, float]]:
    state, out = 0, []
    for symbol, weight in symbols:
        state, written, factor = moves[state, symbol]
        out.append((written, weight * factor))
    return out


def run(symbols: list[tuple[int, float]]) -> float:
    """The weight of a clause, given as symbols and their own weights."""
    backward, forward = machines()
    return sum(w for _, w in _read(forward.moves, _read(backward.moves, symbols[::-1])[::-1]))


class Lexicon:
    """Weights of words and of word beginnings, found in one pass over a text."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        import ahocorasick

        self.words, self.stems = words, stems
        self.closed = {w: (k, 0.0) for k, ws in ((TARGET, TARGETS), (OBJECT, OBJECTS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        self.closed |= {w: (THREAT, 0.5) for w in THREATS}
        self.sizes = sorted({len(s) for s in stems})
        self.any = ahocorasick.Automaton()
        for w in {*words, *stems, *THREATS}:
            self.any.add_word(w, len(w))
        self.any.make_automaton()

    def symbol(self, token: str) -> tuple[int, float]:
        if token in QUOTES:
            return QUOTE, 0.0
        if token in self.words:
            return INSULT, self.words[token]
        if token in self.closed:
            return self.closed[token]
        best = max((self.stems[token[:n]] for n in self.sizes if token[:n] in self.stems), default=0.0)
        return (INSULT, best) if best else (OTHER, 0.0)

    def clauses(self, text: str) -> list[float]:
        """Weights of the clauses in which a term of the lexicon starts a word."""
        low, out, done = text.lower(), [], 0
        for last, size in self.any.iter(low):
            at = last - size + 1
            if at < done or at and low[at - 1].isalpha():
                continue
            start = max(done, *(low.rfind(c, done, at) + 1 for c in ".!?;\n"))
            end = m.start() if (m := _CLAUSE_END.search(low, at)) else len(low)
            done = end
            if weight := run([self.symbol(t) for t in _TOKEN.findall(low[start:end])]):
                out.append(weight)
        return out


def features(lexicon: Lexicon, text: str | None) -> tuple[float, float, float, float]:
    """Of the clauses: the most weight, the log of all weight, how many there are, and their share of the text."""
    found = lexicon.clauses(text) if text else []
    if not found:
        return 0.0, 0.0, 0.0, 0.0
    return min(6.0, max(found)), math.log1p(sum(found)), math.log1p(len(found)), min(1.0, 100 * len(found) / max(100, len(text)))


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    bias: float
    weights: list[float]

    def lexicon(self) -> Lexicon:
        return Lexicon(self.words, self.stems)


def score(model: Model, lexicon: Lexicon, text: str | None) -> float:
    z = model.bias + sum(w * x for w, x in zip(model.weights, features(lexicon, text), strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _terms(text: str) -> dict[str, int]:
    """Every word and word beginning (with * at its end) of a text, with a hash of one of its contexts."""
    out, before = {}, ""
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        context = hash_of(before + " " + word)
        out.setdefault(word, context)
        for n in STEMS:
            if len(word) > n:
                out.setdefault(word[:n] + "*", context)
        before = word
    return out


def hash_of(s: str) -> int:
    import zlib

    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


def _evidence(a: int, b: int, na: int, nb: int) -> float:
    """Log-likelihood ratio of a of na against b of nb; 0 if the first isn't the more frequent."""
    if a * nb <= b * na:
        return 0.0
    p, q, r = a / na, b / nb, (a + b) / (na + nb)
    ll = lambda k, n, x: (k * math.log(x) if k else 0.0) + ((n - k) * math.log(1 - x) if n > k else 0.0)
    return 2 * (ll(a, na, min(p, 1 - 1e-12)) + ll(b, nb, q) - ll(a, na, r) - ll(b, nb, r))


def _contexts(rows: DataFrame, only: set[str] | None) -> DataFrame:
    """term, and in how many different contexts it stands: n0 and n1 in rows of half 0 and of half 1, n in all. Texts are read once for all three."""

    def seen(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: set[tuple[str, int, int]] = set()
        frame = lambda: pd.DataFrame(list(found), columns=["term", "context", "half"])
        for part in parts:
            for x, half in zip(part["text"], part["half"], strict=True):
                found.update((t, c, half) for t, c in _terms(x or "").items() if only is None or t in only)
                if len(found) > HELD_TERMS:  # what is said twice is counted once later on
                    yield frame()
                    found.clear()
        if found:
            yield frame()
            found.clear()
        give_back()

    once = rows.select("text", "half").mapInPandas(seen, "term string, context long, half long").groupBy("term", "context").agg(*(F.max((F.col("half") == h).cast("int")).alias(f"h{h}") for h in (0, 1)))
    return once.groupBy("term").agg(F.sum("h0").alias("n0"), F.sum("h1").alias("n1"), F.count("*").alias("n"))


def _learn_terms(rows: DataFrame) -> dict[str, tuple[dict[str, float], dict[str, float]]]:
    """Weights of words and of word beginnings, as learned from half 0 (by n0), from half 1 (n1) and from all rows (n)."""
    by = ("n0", "n1", "n")
    sizes = rows.groupBy("y").agg(*(F.count_distinct(F.when(F.col("half") == h, F.col("text"))).alias(f"n{h}") for h in (0, 1)), F.count_distinct("text").alias("n")).collect()
    toxic, clean = ({n: next((r[n] for r in sizes if r["y"] == y), 0) for n in by} for y in (1, 0))
    if not toxic["n"] or not clean["n"]:
        return {n: ({}, {}) for n in by}
    # words are learned at most MAX_TERMS * 20 at a time: the most frequent among those that are frequent enough
    top = _contexts(rows.where("y = 1"), None).where(F.col("n") >= MIN_CONTEXTS).orderBy(F.desc("n"), "term").limit(MAX_TERMS * 20).collect()
    a = {r["term"]: r for r in top}
    b = {r["term"]: r for r in _contexts(rows.where("y = 0"), set(a)).collect()}
    return {n: _weigh({t: r[n] for t, r in a.items() if r[n] >= MIN_CONTEXTS}, {t: r[n] for t, r in b.items()}, toxic[n], clean[n]) for n in by}


def _weigh(a: dict[str, int], b: dict[str, int], n_toxic: int, n_clean: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings that stand out in toxic contexts (a, of so many texts) against clean ones (b)."""
    if not n_toxic or not n_clean:
        return {}, {}
    weigh = {}
    for term, n in a.items():
        m = b.get(term, 0)
        odds = math.log((n + 0.5) / (n_toxic + 1)) - math.log((m + 0.5) / (n_clean + 1))
        if odds > 1.5 and _evidence(min(n, n_toxic), min(m, n_clean), n_toxic, n_clean) >= MIN_EVIDENCE:
            weigh[term] = min(3.0, odds / 2)
    stems: dict[str, float] = {}
    for term in sorted((t for t in weigh if t[-1] == "*"), key=lambda t: (len(t), t)):
        if not any(term[:n] in stems for n in STEMS):
            stems[term[:-1]] = weigh[term]
    words = {t: w for t, w in weigh.items() if t[-1] != "*" and not any(t[:n] in stems for n in STEMS)}
    return dict(sorted(words.items(), key=lambda x: (-a[x[0]], x[0]))[:MAX_TERMS]), stems


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Newton's method; the first weight is the bias."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, shrink = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, x.T @ (y - p) - shrink @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, fold: Column, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """Learns from labels of the rows where fold (a condition on key) holds."""
    small_batches(docs.sparkSession)
    own = labels.where(fold & F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
    sizes = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, min(1.0, SAMPLE_TOXIC / max(1, sizes.get(1, 0)))).otherwise(min(1.0, SAMPLE_CLEAN / max(1, sizes.get(0, 0))))
    chosen = own.where(unit_hash(F.col("key"), F.lit(5)) < share).dropDuplicates(["key"])
    chosen = chosen.withColumn("half", F.pmod(F.xxhash64("key", F.lit(55)), F.lit(2)))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")  # of a bounded size
    rows = written(rows.repartition(12), "labelled")

    terms = _learn_terms(rows)

    def learned(n: str) -> Model:
        words, stems = terms[n]
        return Model({w: 1.5 for w in INSULTS} | words, stems, -3.0, [1.5, 1.0, 0.5, 0.0])

    # cross-fitting: the function is fitted on what each half's terms find in the other, and then used with the terms of all
    sent = docs.sparkSession.sparkContext.broadcast({0: learned("n1"), 1: learned("n0")})
    model = learned("n")

    def measured(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicons = {half: m.lexicon() for half, m in sent.value.items()}
        for part in parts:
            yield pd.DataFrame([(*features(lexicons[half], x), y) for x, y, half in zip(part["text"], part["y"], part["half"], strict=True)], columns=[*"abcd", "y"])

    data = rows.mapInPandas(measured, "a double, b double, c double, d double, y int").toPandas().to_numpy(dtype=float)
    if len(data) and 0 < data[:, 4].mean() < 1:
        data = data[np.lexsort(data.T)]
        # classes were sampled at their own rates; rows count as often as they stand for
        rate = {y: max(1.0, sizes.get(y, 0) / most) for y, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))}
        shift = math.log(rate[1]) - math.log(rate[0])
        w = _logistic(data[:, :4], data[:, 4])
        model = Model(model.words, model.stems, float(w[0] + shift), [float(x) for x in w[1:]])
    return model


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from 0.5 on). Columns of docs with these names are replaced."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        lexicon = m.lexicon()
        for part in parts:
            yield pd.Series([score(m, lexicon, x) for x in part], dtype="float64")

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, scored(F.col(text)).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
