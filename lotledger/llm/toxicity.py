"""Toxicity by a weighted finite-state grammar over clauses.

Each text is cut into clauses. A lexical transducer turns the words of a clause into symbols
(insult, threat, target, negation, reported speech, other); a clause transducer reads the
symbols and adds weights by state: an insult aimed at somebody counts apart from one that is
denied, reported or stands alone, and a threat counts only with a target. The two are composed
on the fly, and only in clauses in which the lexicon matches at all. The sums of the matched
clauses are the inputs of a logistic score.

Insult stems and their weights come from labelled texts: words, and beginnings of words, whose
share among toxic texts is higher than chance can explain. They are fitted on a bounded sample
of labelled rows; every text is scored whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotledger.llm.common import python_tasks, bounded_sample, held_out
from lotledger.session import materialise

FIT_ROWS = 12_000  # labelled rows that the lexicon and the score are fitted on, at most
STEM_LENGTHS = (4, 5, 6)  # beginnings of words that may become stems
MIN_TEXTS = 4  # toxic texts in which a stem occurs, at least
MIN_WEIGHT = 2.0  # log odds of a stem, at least

# Closed word classes in the languages of the corpus, fixed values.
THREATS = {
    *"kill hurt destroy beat burn stab shoot hang".split(), *"töten umbringen schlagen verbrennen erschießen".split(),
    *"tuer frapper brûler détruire étrangler".split(), *"matar golpear quemar destruir".split(),
}
TARGETS = {
    *"you your yours he she they them him her these those people".split(),
    *"du dich dir ihr euch sie er ihn ihm diese leute".split(),
    *"tu toi te vous il elle ils elles lui leur ces gens".split(), *"tú te usted ustedes él ella ellos ellas esos gente".split(),
}
NEGATIONS = {
    *"not no never nor cannot isn't aren't don't wasn't".split(), *"nicht kein keine keinen nie niemals".split(),
    *"pas jamais aucun aucune ni".split(), *"nunca jamás ningún ninguna tampoco".split(),
}
REPORTS = {
    *"said says wrote called quoted claimed reported alleged".split(), *"sagte schrieb nannte zitierte behauptete".split(),
    *"dit disait écrit appelé affirmé".split(), *"dijo escribió llamó afirmó".split(),
}

CLAUSE_END = re.compile(r"[.!?;:,\n|]+")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
FEATURES = ("aimed", "plain", "softened", "threat", "strongest", "clauses")


@dataclass
class Transducer:
    """States with arcs from symbol to (next state, name of what is counted)."""

    start: str
    arcs: dict[tuple[str, str], tuple[str, str]] = field(default_factory=dict)

    def step(self, state: str, symbol: str) -> tuple[str, str]:
        return self.arcs.get((state, symbol), (state, ""))


def clause_transducer() -> Transducer:
    """The grammar of a clause: how a threat or insult counts after what came before it."""
    t = Transducer("open")
    for state in ("open", "aimed", "denied", "reported", "menace"):
        t.arcs[state, "negation"] = ("denied", "")
        t.arcs[state, "report"] = ("reported", "")
    for state, count in (("open", "plain"), ("aimed", "aimed"), ("denied", "softened"), ("reported", "softened"), ("menace", "aimed")):
        t.arcs[state, "insult"] = (state, count)
    t.arcs["open", "target"] = t.arcs["aimed", "target"] = ("aimed", "")
    t.arcs["menace", "target"] = ("aimed", "threat")
    t.arcs["open", "threat"] = ("menace", "")
    t.arcs["aimed", "threat"] = ("aimed", "threat")
    t.arcs["denied", "threat"] = t.arcs["reported", "threat"] = ("denied", "")
    return t


class Grammar:
    """The lexical transducer with its weights, composed with the clause transducer."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = dict(words), dict(stems)
        self.classes = {w: c for c, ws in (("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS), ("threat", THREATS)) for w in ws}
        whole = "|".join(map(re.escape, sorted({*self.words, *THREATS})))
        begun = "|".join(map(re.escape, sorted(self.stems)))
        self.hit = re.compile(rf"\b(?:(?:{whole})\b" + (rf"|(?:{begun})[^\W\d_]*" if begun else "") + ")")
        self.clauses = clause_transducer()

    def symbol(self, word: str) -> tuple[str, float]:
        if (weight := self.words.get(word)) is not None:
            return "insult", weight
        for n in STEM_LENGTHS:
            if (weight := self.stems.get(word[:n])) is not None:
                return "insult", weight
        return self.classes.get(word, "other"), 1.0

    def features(self, text: str | None) -> list[float]:
        """Sums over the matched clauses; all zero for a text without a match."""
        sums = dict.fromkeys(FEATURES, 0.0)
        low = (text or "").lower().replace("’", "'")
        done = 0
        for match in self.hit.finditer(low):
            if match.start() < done:
                continue
            # The last clause end before the match, sought from the end of the clause before.
            begin = done
            for before in CLAUSE_END.finditer(low, done, match.start()):
                begin = before.end()
            end = CLAUSE_END.search(low, match.end())
            done = end.start() if end else len(low)
            state, total, pending = self.clauses.start, 0.0, []
            for word in WORD.findall(low, begin, done):
                symbol, weight = self.symbol(word)
                state, counted = self.clauses.step(state, symbol)
                if counted:
                    pending.append((counted, weight))
            for counted, weight in pending:
                # A target or a denial after the insult changes how the clause counts.
                kind = {"aimed": "aimed", "denied": "softened", "reported": "softened"}.get(state, counted) if counted == "plain" else counted
                sums[kind] += weight
                total += weight if kind != "softened" else weight / 2
            sums["clauses"] += bool(pending)
            sums["strongest"] = max(sums["strongest"], total)
        return [math.log1p(sums[name]) for name in FEATURES]


def _terms(text: str) -> set[str]:
    """Words as ``w:`` and their beginnings as ``s:`` of a text."""
    words = set(WORD.findall(text.lower()))
    return {f"w:{w}" for w in words} | {f"s:{w[:n]}" for w in words for n in STEM_LENGTHS if len(w) > n}


def fit_lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with weights from ``text, toxic`` rows.

    A term is taken if a likelihood-ratio test finds it more frequent in toxic texts at the
    5 % level after correction for the number of terms, and its log odds are high enough.
    """

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                seen[int(toxic)].update(_terms(text))
        both = list((seen[0] + seen[1]).items())
        for i in range(0, len(both), 20_000):
            terms, n = zip(*both[i:i + 20_000], strict=True)
            yield pd.DataFrame({"term": terms, "n": n, "t": [seen[1][w] for w in terms]})

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}, {}
    terms = sample.mapInPandas(counts, "term string, n long, t long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where(f"t >= {MIN_TEXTS}")
    tested = terms.withColumn("p", (F.col("t") + 0.5) / (toxic + 1)).withColumn("q", (F.col("n") - F.col("t") + 0.5) / (clean + 1))
    # Only terms that are frequent for toxic texts can come through, so the list is short.
    rows = tested.where(F.log(F.col("p") / F.col("q")) >= MIN_WEIGHT).collect()
    limit = 2 * math.log(max(1, len(rows)) * 20 * 10)
    words, stems = {}, {}
    for r in rows:
        a, n = r["t"], r["n"]
        rate = toxic / (toxic + clean)
        g2 = 2 * sum(x * math.log(x / (n * share)) for x, share in ((a, rate), (n - a, 1 - rate)) if x)
        if g2 > limit:
            (words if r["term"][0] == "w" else stems)[r["term"][2:]] = math.log(r["p"] / r["q"])
    support = {r["term"]: r["t"] for r in rows}
    # The shortest stem that is as sharp stands for longer ones; a stem that one word makes up is that word.
    best = {s: w for s, w in stems.items() if not any(s[:n] in stems and stems[s[:n]] >= w - 0.7 for n in STEM_LENGTHS if n < len(s))}
    # A stem gives way to a longer one that keeps most of its texts and is sharper.
    best = {
        s: w for s, w in best.items()
        if not any(o.startswith(s) and o != s and x > w + 0.5 and support[f"s:{o}"] >= 0.7 * support[f"s:{s}"] for o, x in best.items())
    }
    best = {s: w for s, w in best.items() if support[f"s:{s}"] > 1.5 * max((support[f"w:{x}"] for x in words if x.startswith(s)), default=0)}
    return {w: x for w, x in words.items() if not any(w[:n] in best for n in STEM_LENGTHS)}, best


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Coefficients with the intercept last, by Newton steps with a ridge."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w, keep = np.zeros(design.shape[1]), np.full(design.shape[1], ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + np.diag(keep), design.T @ (y - p) - keep * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    grammar: Grammar
    weights: np.ndarray

    def scores(self, texts) -> np.ndarray:
        x = np.array([self.grammar.features(t) for t in texts], float).reshape(-1, len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """The grammar and score learned from at most about ``rows`` labelled texts.

    Rows held out, rows without an id or label and texts that are null take no part. Without
    both kinds of labels nothing matches and every score is the same.
    """
    python_tasks(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = bounded_sample(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", rows)
    sample = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    # Copies and near copies would count one finding many times: one text of each sketch stays.
    sample = materialise(sample.withColumn("sketch", _sketch("text")), "toxicity-sample")
    sample = sample.groupBy("sketch", "toxic").agg(F.min_by("text", F.struct("doc_id", "text")).alias("text")).select("text", "toxic")
    grammar = Grammar(*fit_lexicon(sample))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [grammar.features(t) for t in batch["text"]], "toxic": batch["toxic"]})

    known = sample.mapInPandas(features, "x array<double>, toxic int").groupBy("x", "toxic").agg(F.count("*").alias("n")).collect()
    x = np.array([r["x"] for r in known for _ in range(r["n"])], float).reshape(-1, len(FEATURES))
    y = np.array([r["toxic"] for r in known for _ in range(r["n"])], float)
    if len(set(y.tolist())) < 2:
        return Model(grammar, np.array([*[0.0] * len(FEATURES), 2.0 if y.any() else -2.0]))
    return Model(grammar, logistic(x, y))


@F.pandas_udf(T.LongType())
def _sketch(texts: pd.Series) -> pd.Series:
    """The smallest hash of three words in a row: mostly the same for near copies."""

    def smallest(text: str) -> int:
        words = WORD.findall(text.lower())
        return min((zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))), default=0)

    return texts.map(smallest)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for every text; null counts as empty."""
    python_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(column, _scorer(shared)(F.col("text")))


def _scorer(shared):
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores(texts), index=texts.index)

    return run
