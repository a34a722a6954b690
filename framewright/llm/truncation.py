"""Text cut off by field limits (problem 4).

Intact values are cut artificially to make positives; a hashed logistic regression over closing characters, punctuation,
last words and how much more often the value's length occurs than its neighbours then scores every value. Word counts,
length counts, both models and the thresholds cover all values: two models are fitted side by side, each on the values of
one half, by gradients summed over tasks, and a value's probability comes from the model that did not see it. The
probability from which a value of a field counts as cut lies where those probabilities are rarest.

Defined cases: null, empty and blank values are no cases; repeated keys are one record, a null key takes no part; null sources are a source of
their own; values and words of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.session import cut

DIMS = 1 << 14
WORD_BINS = 1 << 18
CUTS = 3.0  # what all cuts weigh against all values: many values taken for whole are cut ones, and a missed one weighs more
ROUNDS = (80, 40, 40)  # steps of the fits; each but the first goes on from the one before, without the values taken for cut
PIECE = 500  # records of one value that are cut in one piece
CHUNK = 2_000  # values or cuts whose features are made at once
GRID = 64  # steps of the logarithm of a rarity, for cuts
PRIOR = 200  # values of all fields that a field's own are joined by when its threshold is set
THRESHOLDS = tuple(i / 40 for i in range(6, 27))  # probabilities tried as the border of the cut
EDGE = 1.5
COMMON = 100.0  # per 100,000 values
NUMERIC = 20

_ESCAPE = re.compile(r"(?:&(?:#\d{0,5}|#x[0-9a-fA-F]{0,5}|[a-zA-Z]{0,6})|%[0-9A-Fa-f]?|(?:%[0-9A-Fa-f]{2})+%?[0-9A-Fa-f]?|\\u[0-9a-fA-F]{0,4}|\\x?[0-9a-fA-F]{0,1}|<[^<>]{0,20})$")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
WORDS_JVM = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"  # the same for the JVM
_DOTS = re.compile(r"\s*(?:\.{2,}|…)\s*$")


def word_bin(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % WORD_BINS


def _kind(c: str) -> str:
    if c.isspace():
        return "s"
    if c.isalpha():
        return "U" if c.isupper() else "l"
    if c.isdigit():
        return "9"
    return c if c < "¡" or c in "…»”’—–�" else "e" if ord(c) > 0x2000 else c


def features(value: str, field: str, rarity: tuple[float, float], counts: tuple[np.ndarray, ...], own: float = 0.0) -> tuple[list[int], list[float]]:
    """Hashed indices and numeric features of a value's end."""
    tail = value
    dots = _DOTS.search(tail)
    base = tail[: dots.start()] if dots else tail
    words = _WORD.findall(base)
    w1, w2 = (words[-1] if words else ""), (words[-2] if len(words) > 1 else "")
    mark = (dots.group().strip() if dots else "") + "|" + _kind(tail[-1])
    shape = _kind(base[-1]) if base else ""
    low1, low2 = w1.lower(), w2.lower()
    escape = bool(_ESCAPE.search(tail)) or tail.endswith("�")
    opened = sum(value.count(a) > value.count(b) for a, b in (("(", ")"), ("[", "]"), ("“", "”"), ("«", "»"), ("¿", "?"), ("¡", "!"), ("<", ">")))
    middle, final, longer = counts
    k, k2, k3 = word_bin(low1), word_bin(low2 + " " + low1), word_bin("\n" + last_clause(value))
    m, f, m2, f2, x, same = middle[k], final[k], middle[k2], final[k2], longer[k], final[k3]
    f, f2, same = max(0.0, f - own), max(0.0, f2 - own), max(0.0, same - own)  # without the value itself
    lean = lambda a, b, top=5.0: float(np.clip(np.log((a + 0.5) / (b + 0.5)), -top, top)) / top
    # How the last word, the last pair and the last clause lean: inside or at the end, beginning of a longer word, common or not.
    q, p, g, r, r2, rs = lean(f, m), lean(f2, m2), lean(x, m + f), lean(f, 20), lean(f2, 10), lean(same, 10)
    end = (dots.group().strip() if dots else "") + (shape if shape in "lU9" else "")
    names = [
        f"m{mark}", f"fm{field}{mark}", f"t{tail[-2:] if not tail[-1].isalnum() else ''}", f"c{w1[:1].isupper()}{shape}{field}", f"n{min(len(w1), 9)}{shape}",
        f"k{min(len(words), 12)}{field}", f"e{escape}", f"o{opened}{shape}", f"v{shape}{bool(dots)}{field}", f"D{min(4, len(tail) - len(tail.rstrip('.')))}",
        f"z{end}{m + f > 0}{x > m + f}", f"y{end}{f > m}{f2 > m2}", f"w{end}{x > m + f}{f > m}{same > 10}",
        f"g{field}{end}{round(g * 5)}{m > 0}", f"p{field}{end}{round(p * 5)}{round(rs * 5)}",
    ]
    index = [zlib.crc32(n.encode("utf-8", "replace")) % DIMS for n in names]
    words_end, dotted = float(shape in "lU" and not dots), float(bool(dots))
    leans = [q, p, g, r, r2, rs, max(g, -p), max(g, -q) * max(0.0, -rs)]
    return index, [1.0, np.log1p(rarity[0]), np.log1p(rarity[1]), float(escape), *[v * words_end for v in leans], *[v * dotted for v in leans]]


def stands_alone(value: str, counts: tuple[np.ndarray, ...]) -> bool:
    """Whether a cut left a common complete clause of whole words, which can't be told from an intact one."""
    if value.endswith("..") and not value.endswith("..."):
        return False
    clause = last_clause(value)
    k = word_bin(clause.split(" ")[-1])
    return counts[1][word_bin("\n" + clause)] > COMMON and counts[2][k] <= counts[0][k] + counts[1][k]


def last_clause(value: str) -> str:
    """The words after the last sentence end, in lower case."""
    part = re.split(r"[.!?…。]+\s+", value.strip())[-1]
    return " ".join(_WORD.findall(part.lower()))


def cut_artificially(value: str, rnd: np.random.Generator, limit: int | None = None) -> str | None:
    """An intact value cut inside a word, sentence or encoded character; None if no such cut exists."""
    n = len(value)
    if n < 8:
        return None
    if value.rstrip().endswith("...") and rnd.random() < 0.3:
        return value.rstrip()[:-1]
    for _ in range(6):
        at = limit if limit and limit < n else int(rnd.integers(max(4, n // 2), n))
        limit = None
        kept, lost = value[:at], value[at:]
        if not re.search(r"[^\W_]", lost) or re.search(r"[.!?…。)\"”]\s*$", kept) or re.match(r"\s*[.!?…。,;:]", lost) and kept[-1:].isalnum() or not re.search(r"[^\W_]", kept[-12:]):
            continue
        how = rnd.random()
        if how < 0.08:
            return kept.rstrip() + ("..." if rnd.random() < 0.8 else "…")
        if how < 0.15:
            return kept + " " + rnd.choice(["&am", "&#82", "&quo", "&", "%E2%8", "%C3", "\\u00", "\\u20", "&#3"])
        if how < 0.18:
            return kept + "�"
        return kept.rstrip() if rnd.random() < 0.7 else kept
    return None


def score(theta: np.ndarray, index: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    z = theta[index].sum(axis=1) + numbers @ theta[DIMS:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def by_field(block: dict, fields: int) -> np.ndarray:
    """The numeric features, for all fields and then for each field."""
    own = [block["numbers"] * (block["field"] == i)[:, None] for i in range(fields)]
    return np.concatenate([block["numbers"], *own], axis=1)


def _matrix(values, fields, rarities, counts, own=0.0) -> tuple[np.ndarray, np.ndarray]:
    done = [features(v, f, r, counts, own) for v, f, r in zip(values, fields, rarities)]
    return np.array([i for i, _ in done], dtype=np.int64).reshape(len(done), -1), np.array([x for _, x in done], dtype=float).reshape(-1, NUMERIC)


def rarest(near: np.ndarray) -> float:
    """The lowest of ``THRESHOLDS`` around which there are at most ``EDGE`` times as many values as around the rarest."""
    return next(t for t, n in zip(THRESHOLDS, near) if n <= EDGE * min(near))


def _near(values: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return np.array([weight[np.abs(values - t) < 0.075].sum() for t in THRESHOLDS])


def best_threshold(values: np.ndarray) -> float:
    """The lower edge of where held-out probabilities of values are rarest, between whole values and cut ones.

    Cut values are few, so one that is missed weighs more than one too many: the edge is the lowest probability around which
    there are at most ``EDGE`` times as many values as around the rarest.
    """
    return rarest(_near(values, np.ones(len(values))))


def half(value: str, field: str) -> int:
    """The half of all values that a value belongs to, under any source; the model of the other half rates it."""
    return zlib.crc32(f"{field}\n{value}".encode("utf-8", "replace")) >> 7 & 1


Pairs = tuple[np.ndarray, np.ndarray]  # pairs of rarities and their cumulative numbers of records


def _drawn(upto: np.ndarray, rnd: np.random.Generator) -> int:
    return int(np.searchsorted(upto, rnd.integers(upto[-1]), side="right"))


def cuts_of(value: str, draws: int, rnd: np.random.Generator, limits: tuple[np.ndarray, Pairs] | None, rarities: Pairs, counts: tuple[np.ndarray, ...]) -> list[tuple[str, tuple[float, float], int]]:
    """``draws`` artificial cuts of a value, equal ones once: (cut, rarity, number)."""
    got: dict[tuple[str, int], int] = {}
    able = int(np.searchsorted(limits[0], len(value))) if limits else 0  # limits below the value's length
    for _ in range(draws):
        i = _drawn(limits[1][1][:able], rnd) if able and rnd.random() < 0.7 else -1
        c = cut_artificially(value, rnd, int(limits[0][i]) if i >= 0 else None)
        if c is not None:
            at_limit = i >= 0 and limits[0][i] - 2 <= len(c) <= limits[0][i]
            key = (c, i if at_limit else -1)
            got[key] = got.get(key, 0) + 1
    kept = [(c, i, n) for (c, i), n in got.items() if not stands_alone(c, counts)]
    return [(c, tuple(limits[1][0][i] if i >= 0 else rarities[0][_drawn(rarities[1], rnd)]), n) for c, i, n in kept]


def _totals(blocks: RDD, of: Callable[[dict], np.ndarray], size: int) -> np.ndarray:
    """The sum over all blocks of ``of``; only what is not zero travels."""

    def part(rows: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        total = np.zeros(size)
        for b in rows:
            total += of(pickle.loads(b))
        at = np.flatnonzero(total)
        yield at, total[at]

    out = np.zeros(size)
    for at, x in blocks.mapPartitions(part).collect():
        out[at] += x
    return out


def held_out(block: dict, theta: np.ndarray) -> np.ndarray:
    """Each row's probability by the model that did not see its half."""
    p = np.zeros(len(block["half"]))
    numbers = by_field(block, (theta.shape[1] - DIMS) // NUMERIC - 1)
    for k in (0, 1):
        of = block["half"] == k
        p[of] = score(theta[k], block["index"][of], numbers[of])
    return p


def gradient(block: dict, theta: np.ndarray) -> np.ndarray:
    """For both models the sums over negatives and positives of the other half: gradient, then weight. Common complete clauses are seen by both."""
    out = np.zeros((2, 2, theta.shape[1] + 1))
    every = by_field(block, (theta.shape[1] - DIMS) // NUMERIC - 1)
    for k in (0, 1):
        for y in (0, 1):
            use = ((block["half"] != k) | block["common"]) & (block["y"] == y) & block["keep"]
            index, numbers, weight = block["index"][use], every[use], block["weight"][use]
            if not len(weight):
                continue
            err = (score(theta[k], index, numbers) - y) * weight
            out[k, y, :DIMS] = np.bincount(index.ravel(), np.repeat(err, index.shape[1]), minlength=DIMS)
            out[k, y, DIMS:-1] = numbers.T @ err
            out[k, y, -1] = weight.sum()
    return out.ravel()


def train(blocks: RDD, fields: list[str]) -> tuple[np.ndarray, dict[str, float]]:
    """Two logistic regressions by full-batch Adam over all blocks, one for each half, and the threshold of each field.

    Values that the model of the other half takes for cut are no negatives in the next fit, except common complete clauses.
    """
    size = DIMS + NUMERIC * (1 + len(fields))
    theta, share = np.zeros((2, size)), np.array([1.0, CUTS])[:, None] / (1 + CUTS)
    thresholds = dict.fromkeys(fields, 2.0)  # without any cut nothing can be told
    all_blocks = marked = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    for rounds in ROUNDS:
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, rounds + 1):
            now = theta
            sums = _totals(marked, lambda b: gradient(b, now), 4 * (size + 1)).reshape(2, 2, -1)  # noqa: B023
            if not sums[:, 1, -1].any():
                return theta, thresholds
            grad = (share * sums[:, :, :-1] / np.maximum(sums[:, :, -1:], 1e-9)).sum(axis=1) + 2e-6 * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta = theta - 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        done, tried = theta, len(THRESHOLDS) + 1

        def near(b: dict, done: np.ndarray = done, tried: int = tried) -> np.ndarray:
            p, values = held_out(b, done), b["y"] == 0
            out = np.zeros((len(fields), tried))
            for i in range(len(fields)):
                of = values & (b["field"] == i)
                out[i] = np.r_[_near(p[of], b["weight"][of]), b["weight"][of].sum()]
            return out.ravel()

        around = _totals(all_blocks, near, len(fields) * tried).reshape(len(fields), tried)
        joined = around.sum(axis=0)
        thresholds = {f: rarest(x[:-1] + PRIOR * joined[:-1] / max(1.0, joined[-1])) for f, x in zip(fields, around)}

        def mark(b: bytes, done: np.ndarray = done, limit: np.ndarray = np.array([thresholds[f] for f in fields])) -> bytes:
            block = pickle.loads(b)
            return pickle.dumps(block | {"keep": (block["y"] == 1) | block["common"] | (held_out(block, done) < limit[block["field"]])})

        if marked is not all_blocks:
            marked.unpersist()
        marked = all_blocks.map(mark).persist(StorageLevel.MEMORY_AND_DISK)
    marked.unpersist()
    all_blocks.unpersist()
    return theta, thresholds


def prefix_bins(words: pd.Series) -> pd.Series:
    """The bins of all proper beginnings of each word, in one pass over its letters."""

    def of(word: str) -> list[int]:
        out, code = [], 0
        for c in word[:-1]:
            code = zlib.crc32(c.encode("utf-8", "replace"), code)
            out.append(code % WORD_BINS)
        return out

    return words.map(of)


def find_truncated(df: DataFrame, key: str, source: str, fields: list[str]) -> DataFrame:
    """``key``, source, field_name, value, probability and is_cut for every non-blank value of ``fields``."""
    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(source), F.lit("")).alias("src"), *[F.col(f).alias(f"f_{i}") for i, f in enumerate(fields)]).filter("k is not null").dropDuplicates(["k"])
    named = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"f_{i}").alias("value")) for i, f in enumerate(fields)])
    values = rows.select("k", "src", F.inline(named)).filter(F.col("value").rlike(r"[^\s\p{Z}]")).withColumn("chars", F.length("value")).withColumn("bytes", F.octet_length("value"))

    def rarity(unit: str) -> DataFrame:
        """How much more often a length occurs in its source and field than the lengths within 5 of it."""
        hist = values.groupBy("src", "field", unit).count()
        near = F.sum("count").over(Window.partitionBy("src", "field").orderBy(unit).rangeBetween(-5, 5)) - F.col("count")
        return hist.select("src", "field", unit, (F.col("count") / (1 + near / 10)).alias(f"rare_{unit}"))

    known = cut(values.join(rarity("chars"), ["src", "field", "chars"]).join(rarity("bytes"), ["src", "field", "bytes"]))

    # Words and pairs of neighbouring words: how often they stand inside and at the end of a value, over all values.
    tokens = F.regexp_extract_all(F.lower("value"), F.lit(WORDS_JVM), F.lit(0))
    places = known.select(tokens.alias("w")).filter("size(w) > 0").select(F.size("w").alias("n"), "w", F.posexplode("w").alias("i", "word"))
    words = places.select("word", (F.col("i") == F.col("n") - 1).alias("end"))
    pairs = places.filter("i > 0").select(F.concat_ws(" ", F.get("w", F.col("i") - 1), "word").alias("word"), (F.col("i") == F.col("n") - 1).alias("end"))
    # The words after the last sentence end, as in ``last_clause``.
    trimmed = F.regexp_replace("value", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    clause = F.get(F.reverse(F.split(trimmed, r"[.!?…。]+[\s\p{Z}]+")), F.lit(0))
    clauses = known.select(F.concat(F.lit("\n"), F.array_join(F.regexp_extract_all(F.lower(clause), F.lit(WORDS_JVM), F.lit(0)), " ")).alias("word"), F.lit(True).alias("end"))
    known_words = cut(words.unionByName(pairs).unionByName(clauses).groupBy("word", "end").count())
    bins = known_words.groupBy(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(WORD_BINS)).cast("int").alias("bin")).agg(F.sum(F.when(~F.col("end"), F.col("count"))).alias("m"), F.sum(F.when(F.col("end"), F.col("count"))).alias("f")).fillna(0)
    middle, final = np.zeros(WORD_BINS, dtype=np.float32), np.zeros(WORD_BINS, dtype=np.float32)
    got = bins.toPandas()  # at most WORD_BINS rows
    middle[got["bin"]], final[got["bin"]] = got["m"], got["f"]
    # How often a string is the beginning of a longer word.
    whole = known_words.filter(~F.col("word").rlike(r"[ \n]")).groupBy("word").agg(F.sum("count").alias("count"))
    starts = whole.select("count", F.explode(F.pandas_udf(prefix_bins, "array<int>")("word")).alias("bin"))
    got = starts.groupBy("bin").agg(F.sum("count").alias("x")).toPandas()
    longer = np.zeros(WORD_BINS, dtype=np.float32)
    longer[got["bin"]] = got["x"]
    per = np.float32(1e5 / max(1, known.count()))  # counts per 100,000 values
    middle, final, longer = middle * per, final * per, longer * per
    counts = (middle, final, longer)
    spark = df.sparkSession

    # Rarities of all values on a grid, and the lengths of a field that are frequent in a source: a limit of one source shows in the longer values of others.
    grid = lambda c: F.round(F.log1p(c) * GRID).cast("int")
    pair = known.select("src", "field", "chars", F.greatest("rare_chars", "rare_bytes").alias("most"), grid("rare_chars").alias("a"), grid("rare_bytes").alias("b"))
    back = lambda t: np.expm1(t[["a", "b"]].to_numpy(dtype=float) / GRID)
    every = pair.groupBy("a", "b").count().toPandas().sort_values(["a", "b"])  # at most a grid
    rarities = back(every), every["count"].cumsum().to_numpy()
    often = pair.filter("most >= 2").groupBy("field", "chars", "a", "b").count().toPandas().sort_values(["chars", "a", "b"])
    limits = {o: (t["chars"].to_numpy(), (back(t), t["count"].cumsum().to_numpy())) for o, t in often.groupby("field")}
    # Limits strike the longer values of a field, so those give more cuts. Cutting a cut value gives a cut value again.
    long = {r.field: r.chars for r in known.groupBy("field").agg(F.percentile("chars", F.lit(0.75)).alias("chars")).collect()}
    shared = spark.sparkContext.broadcast((counts, rarities, limits))  # the counts of fixed size, a row a frequent length of a field

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, rarities, limits = shared.value

        def packed(rows: list[tuple], y: int) -> pd.DataFrame:
            value, field, rare, n, side = zip(*rows)
            index, numbers = _matrix(value, field, rare, counts, 0.0 if y else float(per))
            block = {"index": index.astype(np.int16), "numbers": numbers.astype(np.float32), "weight": np.array(n, dtype=float), "half": np.array(side, dtype=np.int8), "y": np.full(len(rows), y, np.int8)}
            block |= {"field": np.array([fields.index(f) for f in field], dtype=np.int16), "keep": np.ones(len(rows), dtype=bool)}
            block["common"] = np.array([not y and (stands_alone(v, counts) or counts[1][word_bin("\n" + last_clause(v))] > max(COMMON, 20 * per)) for v in value])
            return pd.DataFrame({"block": [pickle.dumps(block)]})

        values, cuts = [], []
        for b in batches:
            for src, field, value, chars, nbytes, n, piece in b[["src", "field", "value", "rare_chars", "rare_bytes", "n", "piece"]].itertuples(index=False):
                side = half(value, field)
                if piece == 0:
                    values.append((value, field, (chars, nbytes), n, side))
                rnd = np.random.default_rng(zlib.crc32(f"{piece}\n{src}\n{field}\n{value}".encode("utf-8", "replace")))
                draws = min(PIECE, n - piece * PIECE) * (6 if len(value) >= long[field] else 1)
                cuts += [(c, field, r, k, side) for c, r, k in cuts_of(value, draws, rnd, limits.get(field), rarities, counts)]
                for rows, y in ((values, 0), (cuts, 1)):
                    while len(rows) >= CHUNK:
                        yield packed(rows[:CHUNK], y)
                        del rows[:CHUNK]
        for rows, y in ((values, 0), (cuts, 1)):
            if rows:
                yield packed(rows, y)

    alike = known.groupBy("src", "field", "value", "rare_chars", "rare_bytes").agg(F.count(F.lit(1)).alias("n"))
    pieces = alike.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / PIECE))).alias("piece"))
    packs = cut(pieces.mapInPandas(blocks, "block binary"))
    theta, thresholds = train(packs.rdd.map(lambda r: bytes(r.block)), fields)
    model = spark.sparkContext.broadcast((theta, thresholds))  # fixed size

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        theta, thresholds = model.value
        counts = shared.value[0]
        for b in batches:
            if len(b):
                same = ["field", "value", "rare_chars", "rare_bytes"]
                of = b.groupby(same, sort=False).ngroup().to_numpy()
                one = b[same].drop_duplicates()
                index, numbers = _matrix(one["value"], one["field"], list(zip(one["rare_chars"], one["rare_bytes"])), counts, float(per))
                side = np.array([half(x, f) for x, f in zip(one["value"], one["field"])])
                at = np.array([fields.index(f) for f in one["field"]])
                p = held_out({"index": index, "numbers": numbers.astype(np.float32), "half": side, "field": at}, theta)[of]
                yield pd.DataFrame({"k": b["k"], "src": b["src"], "field_name": b["field"], "value": b["value"], "probability": p, "is_cut": p >= b["field"].map(thresholds).to_numpy()})

    rated = known.select("k", "src", "field", "value", "rare_chars", "rare_bytes").mapInPandas(rate, f"k {kind}, src string, field_name string, value string, probability double, is_cut boolean")
    return rated.withColumnRenamed("k", key).withColumnRenamed("src", source)
