"""Encoding of the whole corpus with a public tokenizer (problem 8), byte-level BPE.

Texts up to ``chunk_chars`` are encoded in one piece. Longer texts are cut into chunks that overlap; every chunk is
pre-tokenised on its own, neighbours are stitched at a place where both see a pre-token border (from there on both
agree), and the pieces between stitches are encoded in parallel and put together by position. If an overlap holds no
common border, the two chunks become one piece. Decoding concatenates the tokens' raw bytes.

Defined cases: null and empty texts have an empty list; blank text is encoded as it is; special-token strings are ordinary text; lone surrogates are replaced as
UTF-8 replacement characters; repeated keys are one document, a null key takes no part; very long texts are encoded whole.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators.dedup import one_per_key

TOKENIZER_DIR = os.environ.get("FRAMEWRIGHT_TOKENIZERS", "/opt/tokenizers")
CHUNK_CHARS = 200_000
OVERLAP_CHARS = 2_000
# Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a rank file, once a worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary(name: str, folder: str = TOKENIZER_DIR) -> str:
    return os.path.join(folder, f"{name}.tiktoken")


def _clean(text: str) -> str:
    return text.encode("utf-8", "replace").decode("utf-8")


def encode_text(text: str, path: str) -> list[int]:
    try:
        return encoding(path).encode_ordinary(text)
    except UnicodeEncodeError:
        return encoding(path).encode_ordinary(_clean(text))


def decode_ids(ids: list[int], path: str) -> str:
    return b"".join(encoding(path).decode_single_token_bytes(i) for i in ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def _pattern():
    import regex

    # The tokenizer's white space is the Unicode property; this library's would take in the control separators too.
    return regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


# The characters of the property White_Space.
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def borders(text: str) -> list[int]:
    """Starts of the pre-tokens of ``text``."""
    return [m.start() for m in _pattern().finditer(text)]


def chunk_borders(text: str, start: int, stop: int, total: int, overlap: int) -> tuple[list[int], list[int], list[int]]:
    """Borders that the chunk [start, stop + overlap) sees in its head [start, start + overlap) and its tail [stop, stop + overlap), and sure ones.

    The last pre-tokens of the window are left out: what follows could change them. White space after anything else
    begins a pre-token whatever comes before, so such places of the head are sure without the neighbour. A place after white
    space is no place to cut: at the end of a piece a run of white space would be one pre-token.
    """
    window_end = min(total, stop + overlap)
    seen = [start + b for b in borders(text)]
    if window_end < total:
        seen = seen[:-2]
    sure = [start + i for i in range(1, min(len(text), overlap)) if text[i] in WHITE and text[i - 1] not in WHITE]
    return [b for b in seen if b < start + overlap], [b for b in seen if stop <= b < window_end and text[b - start - 1] not in WHITE], sure[:1]


def stitch(heads: list[list[int]], tails: list[list[int]], sures: list[list[int]], starts: list[int], total: int) -> list[tuple[int, int]]:
    """Pieces [a, b) of a text. A chunk that never met its neighbours' borders lends none to the next."""
    cuts, synced = [0], True
    for k in range(1, len(starts)):
        common = set(heads[k]) & set(tails[k - 1]) if synced else set()
        places = sorted(p for p in common | set(sures[k]) if p > cuts[-1])
        synced = bool(places)
        if places:
            cuts.append(places[0])
    return list(zip(cuts, [*cuts[1:], total]))


def encode_corpus(docs: DataFrame, key: str, text: str, path: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Columns ``key`` and ids (ARRAY<INT>), one row a document."""
    kind = dict(docs.dtypes)[key]
    rows = one_per_key(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), ["k"])
    size = F.coalesce(F.length("t"), F.lit(0))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "ids": [np.asarray(encode_text(t, path) if isinstance(t, str) else [], dtype=np.int32) for t in b["t"]]})

    short = rows.filter(size <= chunk_chars).mapInPandas(whole, f"k {kind}, ids array<int>")

    long = rows.filter(size > chunk_chars).withColumn("total", F.length("t"))
    # Windows and pieces are cut before they are spread, so that the whole text is not copied beside each of them.
    starts = F.sequence(F.lit(0), F.col("total") - 1, F.lit(chunk_chars))
    windows = F.transform(starts, lambda i: F.struct(i.alias("start"), F.substring("t", i + 1, F.lit(chunk_chars + overlap)).alias("part")))
    window = long.select("k", "total", F.inline(windows)).repartition("k", "start")

    def see(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, total, start, *chunk_borders(part, start, min(total, start + chunk_chars), total, overlap)) for k, total, start, part in b.itertuples(index=False)]
            yield pd.DataFrame(out, columns=["k", "total", "start", "head", "tail", "sure"])

    seen = window.mapInPandas(see, f"k {kind}, total int, start int, head array<int>, tail array<int>, sure array<int>")

    def cut_pieces(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("start")
        total = int(g["total"].iloc[0])
        p = stitch([list(x) for x in g["head"]], [list(x) for x in g["tail"]], [list(x) for x in g["sure"]], list(g["start"]), total)
        return pd.DataFrame({"k": [g["k"].iloc[0]], "a": [[x for x, _ in p]], "b": [[y for _, y in p]]})

    pieces = seen.groupBy("k").applyInPandas(cut_pieces, f"k {kind}, a array<int>, b array<int>")
    cut_out = F.transform(F.arrays_zip("a", "b"), lambda p: F.struct(p["a"].alias("a"), F.substring("t", p["a"] + 1, p["b"] - p["a"]).alias("t")))
    parts = pieces.join(long.select("k", "t"), "k").select("k", F.inline(cut_out)).repartition("k", "a")

    def encode_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "a": b["a"], "ids": [np.asarray(encode_text(t, path), dtype=np.int32) for t in b["t"]]})

    done = parts.mapInPandas(encode_parts, f"k {kind}, a int, ids array<int>")
    joined = done.groupBy("k").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("a", "ids"))), lambda x: x["ids"])).alias("ids"))
    return short.unionByName(joined.select("k", "ids")).withColumnRenamed("k", key)


def token_counts(docs: DataFrame, key: str, text: str, path: str, keep: list[str]) -> DataFrame:
    """``key``, the columns ``keep`` and n_tokens of each document; null and empty texts have 0."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    names = [key, *keep]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[names].copy()
            out["n_tokens"] = [len(encode_text(t, path)) if isinstance(t, str) else 0 for t in b[text]]
            yield out

    schema = ", ".join(f"`{n}` {fields[n]}" for n in names) + ", n_tokens bigint"
    return one_per_key(docs.select(*names, text), [key]).mapInPandas(count, schema)
