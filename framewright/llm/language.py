"""Missing or wrong document language labels (problem 6).

A bidirectional gated recurrent network over bytes (llm.gru), trained here on a bounded sample of labelled documents,
scores every position of every text; the scores are pooled per paragraph and document. A text is cut at sentence ends
into windows of at most ``WINDOW`` bytes; equal windows of a batch are scored once. A document is mixed if one of its
paragraphs speaks clearly against the language of the whole.

One training can go astray on a phrase, and one wrong verdict on a file of cues multiplies by its paragraphs. So several
networks are trained side by side as tasks; on documents kept out of training, the one nearest to what most of them say is
taken, and the margin of its verdicts is the one with fewest wrong rows on kept-out documents and mixtures made of them.

Defined cases: null, empty and blank texts, and texts without letters, have a null language and confidence 0; labels
outside ``languages`` and null labels don't train; paragraphs are numbered from 1 after leading blank lines; every byte
of a long text is scored; repeated keys are one document, a null key takes no part; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import gru
from framewright.llm.sampling import bounded_sample
from framewright.operators.dedup import one_per_key

LANGUAGES = ("en", "zh", "es", "pt", "fr", "de")
WINDOW = 96
HIDDEN = 14
BATCHES = 220
TRAIN_WINDOW = 48
SAMPLE = 5_000  # documents the networks are trained on and chosen by, about; twice that at most
PER_CLASS, PER_DOCUMENT = 8_000, 24  # bounds of the fitting sample: windows a language and a document
CANDIDATES = 4  # networks trained side by side
HELD = 10  # one of so many sampled documents is kept out of training
STRICT = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)  # factors of the margins below, tried on the kept-out documents
SHARPNESS = 6.0  # neighbouring positions agree, so their log probabilities are tempered
PER_BYTE = 1.0  # and log odds per byte of its letters
MIXED_BYTES = 40  # letters' bytes below which a paragraph needs stronger evidence, see SHORT_MARGIN
MARGIN = 4.0  # tempered log odds from which a paragraph speaks clearly against its document
SHORT_MARGIN, SHORT_PER_BYTE, SHORT_HAN = 30.0, 6.0, 4  # the same for few letters, log odds per byte of them; or so many Han letters, most of all

_BREAK = re.compile(r"\n[^\S\n]*\n\s*")
_CLUTTER = re.compile(r"\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?|-->|\[[A-Za-z]{1,4}[_ ]?\d+\]|(?m:^\s*\d+\s*$)|(?m:^\s*[A-Z][A-Z' _.-]{1,40}:)|(?m:^\s*[一-鿿]{1,5}[:：])|https?://\S+|\w+@\w+")
_HINT = re.compile(r"[\d:：@]")
_QUOTED = re.compile(r"[“\"«„][^“”\"«»„\n]{1,60}[”\"»“]|《[^《》\n]{1,40}》|「[^「」\n]{1,40}」|<[^<>]{0,40}>")
_SENTENCE = re.compile(r"[^.!?。！？\n]+[.!?。！？]*\n?|\n|[.!?。！？]+")
_LETTER = re.compile(r"[^\W\d_]")


def paragraphs(text: str) -> list[str]:
    """Blocks of a text between blank lines, leading and trailing blank lines left out."""
    t = text.replace("\r\n", "\n").replace("\r", "\n").strip().strip("﻿").strip()
    return _BREAK.split(t) if t else []


def spoken(paragraph: str) -> str:
    """The paragraph without times, cue numbers, labels and quoted phrases (kept if nothing else is left)."""
    t = _CLUTTER.sub(" ", paragraph) if _HINT.search(paragraph) else paragraph
    if not _QUOTED.search(t):
        return t
    bare = _QUOTED.sub(" ", t)
    return bare if len(_LETTER.findall(bare)) >= 8 else t


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """Sentences as bytes in windows of at most ``size``; no byte of a letter-bearing sentence is left out."""
    out = []
    for s in _SENTENCE.findall(text):
        b = " ".join(s.split()).encode("utf-8", "replace")
        if _LETTER.search(s):
            out += [b[i : i + size] for i in range(0, len(b), size)]
    return out


def train_network(sample: pd.DataFrame, languages: tuple[str, ...] = LANGUAGES, seed: int = 3) -> dict[str, np.ndarray]:
    """Train on the labelled texts of ``sample`` (k, text, lang), then again without the documents that the first network contradicts."""
    docs = [(languages.index(lang), paragraphs(text)) for text, lang in sample.sort_values("k", kind="stable")[["text", "lang"]].itertuples(index=False) if lang in languages and isinstance(text, str)]

    def fitted(use: list[tuple[int, list[str]]], batches: int) -> dict[str, np.ndarray]:
        rnd = np.random.default_rng(seed)
        pool: dict[int, list[bytes]] = {c: [] for c in range(len(languages))}
        for c, parts in use:
            ws = [w for p in parts for w in windows(spoken(p), TRAIN_WINDOW)]
            pool[c] += [ws[i] for i in rnd.permutation(len(ws))[:PER_DOCUMENT]]
        # A sentence found under several labels counts for the label that has most of it, and at most three times.
        counts = {c: Counter(ws) for c, ws in pool.items()}
        total = sum(counts.values(), Counter())
        xs, ys = [], []
        for c, own in counts.items():
            ws = [w for w, n in own.items() if n >= 0.6 * total[w] for _ in range(min(n, 3))]
            pick = rnd.permutation(len(ws))[:PER_CLASS]
            xs += [ws[i] if rnd.random() < 0.6 else ws[i][: int(rnd.integers(12, TRAIN_WINDOW))] for i in pick]
            ys += [c] * len(pick)
        return gru.train(xs, np.array(ys, dtype=int), len(languages), HIDDEN, batches, 256, seed)

    first = fitted(docs, BATCHES // 2)
    heads = score_texts([["\n".join(spoken(p) for p in parts)] for _, parts in docs], first)
    agrees = [int(s[0].argmax()) == c for (c, _), s in zip(docs, heads)]
    of, right = Counter(c for c, _ in docs), Counter(c for (c, _), a in zip(docs, agrees) if a)
    # A language that the first network has not learned keeps all its documents: their labels are not what is wrong.
    return fitted([d for d, a in zip(docs, agrees) if a or 2 * right[d[0]] < of[d[0]]], BATCHES)


def score_texts(texts: list[list[str]], net: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Summed log probabilities (parts, languages) for the parts of each text; equal windows are scored once."""
    seen: dict[bytes, int] = {}
    plan = []
    for parts in texts:
        plan.append([[seen.setdefault(w, len(seen)) for w in windows(spoken(p))] for p in parts])
    scored = gru.window_scores(list(seen), net) if seen else np.zeros((0, net["o"].size), np.float32)
    zero = np.zeros(net["o"].size)
    return [np.array([scored[ws].sum(axis=0) if ws else zero for ws in parts]).reshape(len(parts), net["o"].size) for parts in plan]


def letter_bytes(part: str) -> int:
    """Bytes of the letters of a part; a single Latin sentence counts for less, as close languages share whole sentences' spelling."""
    t = spoken(part)
    letters = "".join(_LETTER.findall(t))
    n = len(letters.encode("utf-8", "replace"))
    alone = n < 2 * len(letters) and sum(1 for s in _SENTENCE.findall(t) if _LETTER.search(s)) < 2
    return int(0.4 * n) if alone else n


def short_evidence(part: str) -> tuple[int, bool]:
    """Bytes of all letters of a part, and whether it is in Han script."""
    letters = _LETTER.findall(spoken(part))
    han = sum("\u3400" <= c <= "\u9fff" for c in letters)
    return len("".join(letters).encode("utf-8", "replace")), han >= SHORT_HAN and 2 * han > len(letters)


def _soft(s: np.ndarray) -> np.ndarray:
    e = np.exp((s - s.max()) / SHARPNESS)
    return e / e.sum()


def judge(parts: np.ndarray, sizes: list[int] | None = None, short: list[tuple[int, bool]] | None = None, strict: float = 1.0) -> tuple[int, float, bool, list[tuple[int, float]]]:
    """Document language, confidence, mixed or not, and (language, confidence) of each part; -1 where nothing was scored."""
    live = np.flatnonzero(parts.any(axis=1))
    if not len(live):
        return -1, 0.0, False, [(-1, 0.0)] * len(parts)
    whole = parts[live].sum(axis=0)
    main = int(whole.argmax())
    lead = parts.max(axis=1) - parts[:, main]
    per_byte = lead / np.maximum(1, sizes if sizes is not None else 1)

    def clear(i: int) -> bool:
        if sizes is None or sizes[i] >= MIXED_BYTES:
            return bool(per_byte[i] >= PER_BYTE * strict)
        n, han = short[i] if short else (sizes[i], False)
        return han or bool(lead[i] / SHARPNESS >= SHORT_MARGIN * strict and lead[i] / max(1, n) >= SHORT_PER_BYTE * strict)

    against = {i: int(parts[i].argmax()) for i in live if lead[i] / SHARPNESS >= MARGIN * strict and clear(i)}
    mixed = bool(against)
    if not mixed:
        c = float(_soft(whole)[main])
        return main, c, False, [(main, c) if parts[i].any() else (-1, 0.0) for i in range(len(parts))]
    allowed = sorted({main, *against.values()})
    out = []
    for i in range(len(parts)):
        if not parts[i].any():
            out.append((-1, 0.0))
            continue
        p = _soft(parts[i])
        best = max(allowed, key=lambda c: p[c])
        out.append((best, float(p[best])))
    return main, float(_soft(whole)[main]), True, out


Verdict = tuple[int, float, bool, list[tuple[int, float]]]


def _evidence(parts: list[str]) -> list:
    return [[f(x) for x in parts] for f in (letter_bytes, short_evidence)] if len(parts) > 1 else []


def verdicts(texts: list[list[str]], net: dict[str, np.ndarray]) -> list[Verdict]:
    """What ``judge`` says of each text, given as its paragraphs."""
    strict = float(net["strict"][0]) if "strict" in net else 1.0
    return [judge(s, *_evidence(p), strict=strict) if p else (-1, 0.0, False, []) for p, s in zip(texts, score_texts(texts, net))]


def _rows(v: Verdict) -> set[tuple[int, int]]:
    return {(i, c) for i, (c, _) in enumerate(v[3], 1)} if v[2] else {(0, v[0])}


def choose_network(nets: list[dict[str, np.ndarray]], held: pd.DataFrame, languages: tuple[str, ...] = LANGUAGES, seed: int = 5) -> dict[str, np.ndarray]:
    """The network nearest to the verdict of most on the kept-out documents (k, text, lang), with its ``strict`` and figures.

    ``off``: rows in which each network differs from most; ``rows``: rows on the kept-out documents; ``wrong``: wrong rows by
    factor of the margins. Mixtures are documents with one paragraph of another language put in; they count as often as
    mixed documents do among the kept-out ones.
    """
    held = held.sort_values("k", kind="stable")
    texts = [paragraphs(t) for t in held["text"]]
    given = [languages.index(x) for x in held["lang"]]
    scores = [score_texts(texts, n) for n in nets]
    evidence = [_evidence(p) for p in texts]
    said = [[judge(x, *e) if p else (-1, 0.0, False, []) for p, x, e in zip(texts, s, evidence)] for s in scores]
    most = []
    for of in zip(*said):
        rows = [frozenset(_rows(v)) for v in of]
        most.append(of[max(range(len(rows)), key=lambda i: (rows.count(rows[i]), -i))])
    off = [sum(len(_rows(v) ^ _rows(m)) for v, m in zip(of, most)) for of in said]
    best = int(np.argmin(off))
    net, mine = dict(nets[best]), scores[best]
    # Documents of one language by their label and by most networks, and mixtures of them.
    clean = [i for i, (m, g) in enumerate(zip(most, given)) if m[0] == g and not m[2]]
    rnd = np.random.default_rng(seed)
    cases: list[tuple[np.ndarray, list, set[tuple[int, int]], float]] = [(mine[i], evidence[i], {(0, given[i])}, 1.0) for i in clean]
    share = max(0.02, sum(m[2] for m in most) / max(1, len(most)))
    mixtures = []
    for i in clean:
        j = clean[int(rnd.integers(len(clean)))]
        part = int(rnd.integers(len(texts[j])))
        if given[i] == given[j] or not mine[j][part].any():
            continue
        at = int(rnd.integers(len(texts[i]) + 1))
        joined = [*texts[i][:at], texts[j][part], *texts[i][at:]]
        spoke = np.insert(mine[i], at, mine[j][part], axis=0)
        lang = [given[j] if k == at else given[i] for k in range(len(joined))]
        mixtures.append((spoke, _evidence(joined), {(k, c if spoke[k - 1].any() else -1) for k, c in enumerate(lang, 1)}, share))
    cases += mixtures
    wrong = [sum(w * len(_rows(judge(x, *e, strict=f)) ^ true) for x, e, true, w in cases) for f in STRICT] if len(clean) >= 20 and mixtures else [0.0] * len(STRICT)
    least = min(wrong)
    strict = min((f for f, w in zip(STRICT, wrong) if w <= least + 1e-9), key=lambda f: (abs(np.log(f)), f))
    figures = {"strict": np.array([strict]), "off": np.array(off), "rows": np.array([sum(len(_rows(m)) for m in most)]), "wrong": np.array(wrong)}
    return net | figures


def fit_network(docs: DataFrame, key: str, text: str, lang: str, languages: tuple[str, ...] = LANGUAGES, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Train ``CANDIDATES`` networks on a bounded sample of the labelled documents, as tasks side by side, and choose one."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("k is not null")
    learn = bounded_sample(rows.filter(F.col("lang").isin(*languages) & F.col("text").isNotNull()), ["k"], sample).dropDuplicates(["k"]).toPandas()
    learn = learn.sort_values("k", kind="stable").reset_index(drop=True)
    held = learn.index % HELD == HELD - 1
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(learn[~held])  # at most 2 * SAMPLE documents

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for seed in b["id"]:
                yield pd.DataFrame({"id": [seed], "net": [pickle.dumps(train_network(shared.value, languages, 3 + int(seed)))]})

    done = spark.range(0, CANDIDATES, 1, CANDIDATES).mapInPandas(fit, "id long, net binary").toPandas().sort_values("id")
    return choose_network([pickle.loads(n) for n in done["net"]], learn[held], languages)


def label_documents(docs: DataFrame, key: str, text: str, lang: str, languages: tuple[str, ...] = LANGUAGES, sample: int = SAMPLE, net: dict[str, np.ndarray] | None = None) -> tuple[DataFrame, dict]:
    """Rows ``key``, para_no (0: the document), found_lang, confidence, mixed, label; and the network (``net``, if given)."""
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("k is not null")
    net = net or fit_network(docs, key, text, lang, languages, sample)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # about 257 * 3 * HIDDEN * 2 floats

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = lambda c: languages[c] if c >= 0 else None
        for b in batches:
            out = []
            for k, given, (main, sure, mixed, each) in zip(b["k"], b["lang"], verdicts([paragraphs(t) if isinstance(t, str) else [] for t in b["text"]], shared.value)):
                out.append((k, 0, name(main), sure, mixed, given))
                if mixed:
                    out += [(k, i, name(c), p, True, given) for i, (c, p) in enumerate(each, 1)]
            yield pd.DataFrame(out, columns=["k", "para_no", "found_lang", "confidence", "mixed", "label"])

    done = one_per_key(rows, ["k"]).mapInPandas(label, f"k {kind}, para_no int, found_lang string, confidence double, mixed boolean, label string")
    return done.withColumnRenamed("k", key), net


def script_of_groups(rows: DataFrame, group: str, text: str, net: dict, languages: tuple[str, ...] = LANGUAGES, cjk: tuple[str, ...] = ("zh",)) -> DataFrame:
    """``group``, script (cjk or latin) and confidence of all texts of each group, pooled from the network's positions."""
    kind = dict(rows.dtypes)[group]
    shared = rows.sparkSession.sparkContext.broadcast(net)
    han = [languages.index(c) for c in cjk]

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            scores = score_texts([[t] if isinstance(t, str) else [] for t in b["text"]], shared.value)
            says = [float(s.sum(axis=0)[han].max() - np.delete(s.sum(axis=0), han).max()) if len(s) else 0.0 for s in scores]
            # Each text's say is bounded, so that slips cannot outweigh the rest; summed per batch before the shuffle.
            g = pd.DataFrame({"g": b["g"], "say": np.clip(says, -40, 40)}).groupby("g", as_index=False).sum()
            yield g

    said = rows.select(F.col(group).alias("g"), F.col(text).alias("text")).filter("g is not null").mapInPandas(pool, f"g {kind}, say double")
    total = said.groupBy("g").agg(F.sum("say").alias("say")).filter("say <> 0")
    script = F.when(F.col("say") > 0, "cjk").otherwise("latin")
    return total.select(F.col("g").alias(group), script.alias("script"), (1 / (1 + F.exp(-F.abs("say") / SHARPNESS))).alias("confidence"))
