"""Reading level of each document (problem 10).

Gradient-boosted regression trees (llm.boosting) over distributions of sentence and word length, vocabulary, syntax and
cohesion, trained on the graded documents. Each source is held out in turn; the held-out predictions calibrate the
grades (isotonic regression) and give the error by source. The level is the calibrated prediction; the raw one, which
also keeps documents of one level apart, stands beside it. Which language a text is in, and whether in one, the network
of problem 6 says (llm.language).

With ``every``, texts that are not in English throughout get a level too: from trees over the measures that other languages
share (length, vocabulary, binding words, cohesion), trained on the same graded documents, each paragraph read with the
function words and letters a word of its language, Han text cut at its function words. No grade exists in another language,
so the error of these levels is known for English only.

Defined cases: null, empty and blank texts have a null level, and without ``every`` so have texts that are not in English
throughout; with it a text without a word has the lowest level; null grades and grades of unknown documents don't train;
graded texts are English by definition; repeated keys are one document, a null key takes no part; long texts are measured
whole; without any grade every level is null; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import boosting
from framewright.llm.language import LANGUAGES, fit_network, paragraphs, spoken, verdicts
from framewright.llm.sampling import bounded_sample
from framewright.operators.dedup import one_per_key

SAMPLE = 10_000  # graded documents the trees are fitted on, about; twice that at most
DEMANDING = 2.5
ENGLISH = LANGUAGES.index("en")

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_END = re.compile(r"[.!?…]+[\"”’)]*(?:\s+|$)|\n+")
_VOWELS = re.compile(r"[aeiouy]+")
# Function words of each language, which the measures keep apart from words of content, and words that bind clauses.
FUNCTION_WORDS = {
    "en": "the of and to a in that is was he for it with as his on be at by i this had not but from they she which you her were would there been their who what if out so up said when will more no them can just into your about did me my we him then an are or do does how all any has have its let look call why".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien mi tu qué ese si es".split(),
    "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser quando muito há nos já está eu também só pelo pela até isso ela entre era depois sem mesmo aos ter seus quem nas me esse eles você meu minha teu tua".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se le ce il sont la avec elle son mais je nous vous ou si leur y dont tout on ma mon ta ton sa cette aux d l c qu n s j".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei ich wir mein dein kein".split(),
}
CONNECTIVES = frozenset("because although though however therefore thus hence whereas unless until while since moreover nevertheless consequently thereby lest whether such whose whom which upon whereby".split())
COORDINATORS = frozenset("and but or so then".split())
_LANG = {name: frozenset(words) for name, words in FUNCTION_WORDS.items()}
_EN = _LANG["en"]


def spoken_parts(text: str) -> list[str]:
    return [spoken(p) for p in paragraphs(text)]


def _syllables(word: str) -> int:
    return max(1, len(_VOWELS.findall(word)) - (word.endswith("e") and not word.endswith("le")))


def _at(values: list, *places: float) -> list[float]:
    """Values at shares of the sorted list."""
    v = sorted(values)
    return [float(v[int(p * (len(v) - 1) + 0.5)]) for p in places]


def _spread(values: list, mean: float) -> float:
    return (sum((x - mean) ** 2 for x in values) / len(values)) ** 0.5


_NOUNS = ("tion", "sion", "ment", "ness", "ity", "ance", "ence", "ism", "acy")
_BE, _PERSON, _LINK = frozenset("be were was is been are".split()), frozenset("i you he she we they me my".split()), frozenset("of to by upon whose whom that which".split())


@functools.lru_cache(maxsize=200_000)
def _facts(w: str) -> tuple:
    """What the measures ask of a word, once a worker for each frequent word."""
    return (len(w), _syllables(w), w not in _EN, w in CONNECTIVES, w in COORDINATORS, w.endswith(_NOUNS), w.endswith("ly"), w.endswith("ing"), w.endswith("ed"), w in _BE, w in _PERSON, w in _LINK)


def measures(text: str, parts: list[str] | None = None) -> np.ndarray:
    """Length, vocabulary, syntax and cohesion of a text."""
    body = "\n".join(spoken_parts(text) if parts is None else parts)
    sentences, commas = [], []
    for s in _END.split(body):
        w = [x.lower() for x in _WORD.findall(s)] if s else []
        if w:
            sentences.append(w)
            commas.append(s.count(",") + s.count(";") + s.count(":"))
    if not sentences:
        return np.zeros(N_MEASURES)
    facts = [[_facts(w) for w in s] for s in sentences]
    flat = [f for s in facts for f in s]
    n, k = len(flat), len(sentences)
    size = [len(s) for s in sentences]
    letters = [f[0] for f in flat]
    own = [f[0] for f in flat if f[2]] or [0]
    heavy = [sum(f[0] >= 8 for f in s) / len(s) for s in facts]
    t = [sum(f[i] for f in flat) for i in range(1, 12)]
    syllables, content, bonds, joins = t[0] / n, t[1], t[2], t[3]
    sets = [frozenset(w for w, f in zip(s, fs) if f[2]) for s, fs in zip(sentences, facts)]
    overlap = [len(a & b) / max(1, min(len(a), len(b))) for a, b in zip(sets, sets[1:])] or [0.0]
    types = {w for s in sentences for w in s}
    bases = set().union(*sets)
    mean, mean_letters = n / k, sum(letters) / n
    return np.array([
        *_at(size, 0.1, 0.5, 0.9), mean, _spread(size, mean), math.log1p(k), math.log1p(n),
        mean_letters, _spread(letters, mean_letters), *_at(own, 0.5, 0.75, 0.9), sum(own) / len(own), syllables, sum(f[1] >= 3 for f in flat) / n, sum(f[1] >= 4 for f in flat) / n, sum(x >= 8 for x in letters) / n, sum(x >= 11 for x in letters) / n, sum(x <= 3 for x in letters) / n,
        *_at(heavy, 0.1, 0.5, 0.9), sum(x > 20 for x in size) / k, sum(h > 0.25 for h in heavy) / k, sum(x for x, h in zip(size, heavy) if h > 0.25) / n,
        len(types) / n, len(bases) / max(1, content), content / n, len(bases) / max(1, len(types)),
        sum(commas) / n * 10, sum(commas) / k, bonds / n * 10, joins / n * 10, bonds / k, joins / k,
        *(x / n * 10 for x in t[4:]),
        sum(overlap) / len(overlap), len({s[0] for s in sentences}) / k, 0.39 * mean + 11.8 * syllables - 15.59,
    ])


N_MEASURES = 45

# What brings a running word's letters to English length, and words that bind or join clauses.
LETTERS = {"en": 1.0, "es": 0.95, "pt": 0.95, "fr": 0.95, "de": 0.83, "zh": 2.6}
BINDERS = {
    "en": CONNECTIVES,
    "es": frozenset("porque aunque sin embargo mientras cuando que cual cuales cuyo cuya quien quienes si hasta desde pues donde".split()),
    "pt": frozenset("porque embora porém enquanto quando que qual quais cujo cuja quem se até desde pois onde portanto".split()),
    "fr": frozenset("parce quoique cependant pendant quand que qui dont lequel laquelle lesquels si jusque depuis car où lorsque puisque".split()),
    "de": frozenset("weil obwohl jedoch daher während dass wenn als bis seit damit ob dessen deren denen welche welcher welches wobei".split()),
    "zh": frozenset("因为 所以 虽然 但是 然而 因此 如果 要是 直到 由于 从而 以及 其 之 否则 不仅 而且".split()),
}
JOINERS = {"en": COORDINATORS, "es": frozenset("y e o pero".split()), "pt": frozenset("e ou mas".split()), "fr": frozenset("et ou mais".split()), "de": frozenset("und oder aber".split()), "zh": frozenset("和 与 或 然后 还".split())}
ZH_WORDS = frozenset("的 了 在 是 不 我 你 他 她 它 我们 你们 他们 这 那 这个 那个 就 也 都 还 和 与 或 但 把 被 从 到 对 给 让 为 要 会 能 有 没有 没 说 去 来 上 下 里 后 前 过 着 吗 吧 呢 啊 什么 谁 怎么 为什么 到底 一 个 份 枚 很 太 任何 之 其 以 而 于 并 所 地 得".split()) | BINDERS["zh"] | JOINERS["zh"]
_HAN = re.compile("[\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
_HAN_WORDS = re.compile("|".join(sorted(ZH_WORDS, key=lambda w: (-len(w), w))))
_END_ANY = re.compile(r"[.!?…]+[\"”’)]*(?:\s+|$)|[。！？；…]+[\"”’」』）]*|\n+")
_COMMA = re.compile("[,;:，、：]")


def _cut_words(sentence: str) -> list[str]:
    """Words in small letters; Han text is cut at its function words, what lies between them into at most four characters."""
    out = []
    for w in _WORD.findall(sentence):
        if not _HAN.search(w):
            out.append(w.lower())
            continue
        at = 0
        for m in [*_HAN_WORDS.finditer(w), None]:
            gap = w[at : m.start() if m else len(w)]
            out += [gap[i : i + 4] for i in range(0, len(gap), 4)]
            if m:
                out.append(m.group())
                at = m.end()
    return out


def shared_measures(parts: list[str], tongues: list[str]) -> np.ndarray | None:
    """Length, vocabulary, binding and cohesion of a text whose paragraphs are in ``tongues``; None without a word."""
    facts, commas = [], []
    for p, k in zip(parts, tongues):
        for s in _END_ANY.split(p):
            words = _cut_words(s) if s else []
            if words:
                commas.append(len(_COMMA.findall(s)))
                facts.append([(w, len(w) * LETTERS[z], w not in (ZH_WORDS if z == "zh" else _LANG[z]), w in BINDERS[z], w in JOINERS[z]) for w in words for z in ["zh" if _HAN.search(w) else "en" if k == "zh" else k]])
    if not facts:
        return None
    flat = [f for s in facts for f in s]
    n, k = len(flat), len(facts)
    size, letters = [len(s) for s in facts], [f[1] for f in flat]
    own = [f[1] for f in flat if f[2]] or [0]
    heavy = [sum(f[1] >= 7.5 for f in s) / len(s) for s in facts]
    content, bonds, joins = (sum(f[i] for f in flat) for i in (2, 3, 4))
    sets = [frozenset(f[0] for f in s if f[2]) for s in facts]
    overlap = [len(a & b) / max(1, min(len(a), len(b))) for a, b in zip(sets, sets[1:])] or [0.0]
    mean, mean_letters = n / k, sum(letters) / n
    return np.array([
        *_at(size, 0.1, 0.5, 0.9), mean, _spread(size, mean), mean_letters, _spread(letters, mean_letters), *_at(own, 0.5, 0.75, 0.9), sum(own) / len(own),
        sum(x >= 7.5 for x in letters) / n, sum(x >= 10.5 for x in letters) / n, sum(x < 3.5 for x in letters) / n, *_at(heavy, 0.1, 0.5, 0.9), sum(h > 0.25 for h in heavy) / k, sum(x > 20 for x in size) / k,
        content / n, len({f[0] for f in flat}) / n, sum(commas) / n * 10, sum(commas) / k, bonds / n * 10, joins / n * 10, bonds / k, joins / k,
        sum(overlap) / len(overlap), len({s[0][0] for s in facts}) / k,
    ])


def train_levels(x: np.ndarray, y: np.ndarray, sources: list[str]) -> dict:
    """Trees on all graded texts, calibration and error from predictions with the source (in at most 5 groups) held out."""
    names = sorted(set(sources), key=lambda s: (-sources.count(s), s))
    group = np.array([names.index(s) % 5 for s in sources])
    out = np.full(len(y), float(y.mean()))
    for g in sorted(set(group)):
        rest = group != g
        if rest.sum() >= 20:
            out[~rest] = boosting.predict(boosting.fit(x[rest], y[rest], trees=50), x[~rest])
    model = boosting.fit(x, y)
    model["knots"], model["levels"] = boosting.isotonic(out, y)
    model["errors"] = {s: (int(sum(np.array(sources) == s)), float(np.abs(out - y)[np.array(sources) == s].mean()), float((np.clip(np.round(out), 1, 3) == y)[np.array(sources) == s].mean())) for s in names}
    return model


def grade_documents(docs: DataFrame, labels: DataFrame, key: str, text: str, lang: str, source: str, grade: str, sample: int = SAMPLE, every: bool = False, net: dict | None = None) -> tuple[DataFrame, dict | None]:
    """Rows ``key``, source, english, level (calibrated, 1 to 3; with ``every`` for texts of any language), raw_level; and the model with its held-out errors.

    ``net`` is the network that tells languages apart; without it one is trained on the labelled documents.
    """
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(source).alias("src")).filter("k is not null")
    model = fit_levels(docs, labels, key, text, source, grade, sample, every)
    net = net or fit_network(docs, key, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast((model, net))  # at most 80 trees of 15 nodes, with ``every`` twice that, and one network

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, network = shared.value
        for b in batches:
            whole = [paragraphs(t) if isinstance(t, str) else [] for t in b["text"]]
            said = verdicts(whole, network)
            ok = np.array([main == ENGLISH and not mixed for main, _, mixed, _ in said], dtype=bool)
            level, plain = np.full(len(b), np.nan), np.full(len(b), np.nan)
            if m is not None:
                todo = [(m, {i: measures("", [spoken(p) for p in whole[i]]) for i in np.flatnonzero(ok)})]
                if every:
                    rest = {i: shared_measures([spoken(p) for p in whole[i]], [LANGUAGES[c] for c, _ in said[i][3]]) for i in np.flatnonzero(~ok) if whole[i]}
                    level[[i for i, x in rest.items() if x is None]] = 1.0
                    todo.append((m["shared"], {i: x for i, x in rest.items() if x is not None}))
                for own, of in todo:
                    if of:
                        at = list(of)
                        plain[at] = boosting.predict(own, np.array(list(of.values())))
                        level[at] = np.clip(np.interp(plain[at], own["knots"], own["levels"]), 1, 3)
            null = lambda x: [None if np.isnan(v) else float(v) for v in x]
            yield pd.DataFrame({"k": b["k"], "src": b["src"], "english": ok, "level": null(level), "raw_level": null(plain)})

    done = one_per_key(rows, ["k"]).mapInPandas(rate, f"k {kind}, src string, english boolean, level double, raw_level double")
    return done.withColumnRenamed("k", key).withColumnRenamed("src", source), model


def fit_levels(docs: DataFrame, labels: DataFrame, key: str, text: str, source: str, grade: str, sample: int = SAMPLE, every: bool = False) -> dict | None:
    """The trees of ``grade_documents``, fitted on a bounded sample of the graded documents; ``errors`` by held-out source."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(source).alias("src")).filter("k is not null")
    graded = labels.filter(F.col(grade).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(grade).cast("double").alias("y"))
    learn = rows.filter(F.col("text").rlike(r"\p{L}")).join(bounded_sample(graded, ["k"], sample), "k").dropDuplicates(["k"]).toPandas().sort_values("k", kind="stable")
    if not len(learn):
        return None
    y, sources = learn["y"].to_numpy(), [s if isinstance(s, str) else "" for s in learn["src"]]
    parts = [spoken_parts(t) for t in learn["text"]]
    model = train_levels(np.array([measures("", p) for p in parts]), y, sources)
    if every:
        x = [shared_measures(p, ["en"] * len(p)) for p in parts]
        has = np.array([v is not None for v in x])
        model["shared"] = train_levels(np.array([v for v in x if v is not None]), y[has], [s for s, h in zip(sources, has) if h])
    return model


def errors_by_source(model: dict | None) -> list[tuple[str, int, float, float]]:
    """(source, graded documents, mean absolute error, share of right levels) with the source held out."""
    return [(s, n, e, r) for s, (n, e, r) in sorted(model["errors"].items())] if model else []
