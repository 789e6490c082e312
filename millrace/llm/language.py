"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lowered, everything but letters becomes a gap, and n-grams of one to three characters (gaps
included) are hashed to 2 ** POWER columns. TF is 1 + ln(count), IDF comes from every training text with a language, rows
have length one. Weights come from follow-the-regularised-leader steps with an elastic net over a bounded
sample (SAMPLE texts a language, chosen by a hash of the key); a temperature, fitted on a fifth of the
sample that takes no steps, calibrates the probabilities.

A text that is null or has no letter is `und` with score 0, as is every text if there is nothing to learn
from. Rows without a language are predicted but not learned from. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, small_batches, unit_hash

POWER = 15
#: Texts of a language that steps are taken on, about; and of all languages together (about 10 KB each on the driver).
SAMPLE, SAMPLE_ROWS = 500, 40_000
#: Languages that a model has room for (a megabyte each); with more training is refused, none is left out silently.
LANGUAGES = 1000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.02

_letters: np.ndarray | None = None


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)
    return _letters[codes]


def grams(text: str | None) -> np.ndarray | None:
    """The hashed column of every n-gram of a text; None if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(codes) or not (letter := _is_letter(codes)).any():
        return None
    c = np.where(letter, codes, np.uint32(32))
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)  # one gap for a run of gaps
    c = np.concatenate(([32], c[keep], [32])).astype(np.uint32)
    with np.errstate(over="ignore"):
        one = c * np.uint32(0x9E3779B1)
        two = one[:-1] * np.uint32(31) + c[1:] * np.uint32(0x85EBCA6B) + np.uint32(7)
        three = two[:-1] * np.uint32(37) + c[2:] * np.uint32(0xC2B2AE35) + np.uint32(11)
        h = np.concatenate((one, two, three))
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - POWER)).astype(np.int64)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """The columns that a text has, and how often."""
    if (h := grams(text)) is None:
        return None
    n = np.bincount(h, minlength=1 << POWER)
    at = np.flatnonzero(n)
    return at, n[at]


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray  # columns by classes, the last row is the bias
    temperature: float = 1.0

    def row(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = (1 + np.log(n)) * self.idf[at]
        return x / np.sqrt(x @ x)

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.row(at, n) @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if (found := counted(text)) is None:
            return "und", 0.0
        p = _softmax(self.logits(*found) / self.temperature)
        k = int(p.argmax())
        return self.classes[k], float(min(1.0, p[k]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(classes: list[str], idf: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Follow the regularised leader, one row at a time; every fifth row is left for the temperature."""
    k, d = len(classes), len(idf)
    model = Model(classes, idf, np.zeros((d + 1, k)))
    xs = [(np.append(at, d), np.append(model.row(at, n), 1.0), y) for at, n, y in rows]
    learn, check = [x for i, x in enumerate(xs) if i % 5], xs[::5]
    z, g2 = np.zeros((d + 1, k)), np.zeros((d + 1, k))
    l1 = np.full((d + 1, 1), L1)
    l1[d] = 0  # the bias isn't shrunk

    def leader(at: np.ndarray) -> np.ndarray:
        zz, gg, ll = z[at], g2[at], l1[at]
        return np.where(np.abs(zz) <= ll, 0.0, (np.sign(zz) * ll - zz) / ((BETA + np.sqrt(gg)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, y in learn:
            w = leader(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = np.outer(x, p)
            step = g * g
            z[at] += g - (np.sqrt(g2[at] + step) - np.sqrt(g2[at])) / ALPHA * w
            g2[at] += step
    model.weights = leader(np.arange(d + 1))
    if check:
        logits, ys = np.array([x @ model.weights[at] for at, x, _ in check]), np.array([y for *_, y in check])
        loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(ys)), ys] + 1e-12).mean()
        model.temperature = float(min(np.exp(np.linspace(np.log(0.05), np.log(5), 60)), key=loss))
    return model


def train(docs: DataFrame, fold: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """Learns from the rows of docs where fold holds: IDF from all their texts that have a language, weights from about sample texts a language."""
    small_batches(docs.sparkSession)
    own = docs.where(fold).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    own = own.where("lang is not null")
    sizes = own.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if not sizes:
        return None
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    sample = max(5, min(sample, SAMPLE_ROWS // len(sizes)))

    def frequencies(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(1 << POWER, dtype=np.int64), 0
        for part in parts:
            for x in part["text"]:
                if (h := grams(x)) is not None:
                    seen = np.zeros(1 << POWER, dtype=bool)
                    seen[h] = True
                    df += seen
                    n += 1
        yield pd.DataFrame({"at": np.append(np.arange(1 << POWER), -1), "n": np.append(df, n)})

    # 2 ** POWER rows come to the driver, however many texts there are
    df = own.select("text").mapInPandas(frequencies, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    total = int(df.loc[df["at"] == -1, "n"].sum())
    n = np.zeros(1 << POWER)
    df = df[df["at"] >= 0]
    n[df["at"].to_numpy()] = df["n"].to_numpy()
    idf = np.log((1 + total) / (1 + n)) + 1

    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], min(1.0, sample / r["count"])).otherwise(share)

    def features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = [(r.key, r.lang, found[0].astype(np.int32).tobytes(), found[1].astype(np.int32).tobytes()) for r in part.itertuples() if (found := counted(r.text))]
            yield pd.DataFrame(out, columns=["key", "lang", "at", "n"])

    kind = dict(own.dtypes)["key"]
    chosen = own.where(unit_hash(F.col("key"), F.lit(8)) < share).mapInPandas(features, f"key {kind}, lang string, at binary, n binary")
    rows = sorted(chosen.orderBy(F.xxhash64("key")).collect(), key=lambda r: str(r["key"]))
    if not rows:
        return None
    classes = sorted({r["lang"] for r in rows})
    number = {c: i for i, c in enumerate(classes)}
    order = np.random.default_rng(8).permutation(len(rows))
    return fit(classes, idf, [(np.frombuffer(rows[i]["at"], np.int32), np.frombuffer(rows[i]["n"], np.int32), number[rows[i]["lang"]]) for i in order])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score. Columns of docs with these names are replaced."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        m = sent.value
        return pd.DataFrame([m.predict(x) if m else ("und", 0.0) for x in texts], columns=["lang", "score"])

    kept, found = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")], free_name(docs, "_predicted")
    return docs.select(*kept, predicted(F.col(text)).alias(found)).select(*kept, F.col(f"{found}.lang").alias("lang_pred"), F.col(f"{found}.score").alias("score"))
