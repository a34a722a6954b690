"""Speech transcripts into clean speaker turns (problem 3).

Each segment is read once into pieces (label, speech or not, cleaned text). Labels are normalised against the roster of
the transcript's group: phonetic blocks (consonant skeletons and their one-letter deletions) bring label and roster
variants together by equality, an optimal assignment of name parts gives the cost of a pair, and an optimal assignment of
a group's labels to the forms of its persons says who is meant. Runs of speech by one person come from sharded scans, so a
marathon recording is no single task.

Defined cases: repeated keys are one record; null or blank texts and texts of only times, fillers, sounds or labels are
no speech; a segment flagged as risky whose words are all doubtful is no speech, whatever its labels (null flags and null
or empty words do not count as doubtful); speech before anyone is named has a null speaker and is left out of the turns;
labels that two persons fit equally well stay unresolved; an unresolved name before a colon is part of the speech, an
unresolved bracket is a sound; names and brackets may be of any length and script; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.operators.sharding import _null_safe_join, distinct_in_shard, fill_before, lead_over
from framewright.session import cut

SHARD_IDS = 2048
# Hesitations, and titles that can stand before a family name.
FILLERS_LATIN = ("um", "umm", "uh", "uhh", "er", "err", "erm", "hm", "hmm", "hmmm", "mm", "mmm", "uhm", "ah", "eh", "huh", "mhm")
FILLERS_HAN = "呃额嗯唔啊哦噢诶欸喔呣"

_TIME = re.compile(r"[\[(<（【]?\s*(?<!\d)\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?(?!\d)\s*[\])>）】]?")
_VOICE = r"(?:\s*[(（]\s*(?:V\.?\s?O\.?|O\.?\s?S\.?|O\.?\s?C\.?|off[- ]?screen|voice[- ]?over|画外音|旁白|内心独白)\s*[)）])?"
# A full stop stands inside a name only after a title or an initial.
_LETTER = r"[^\W\d_]"
_PART = rf"(?:(?:[Mm]rs?|[Mm]s|[Dd]r|[Pp]rof|[Ss]t|[Jj]r|[Ss]r|[Cc]apt|[Ll]t|[Gg]en|[Cc]ol|{_LETTER})\.|{_LETTER}(?:{_LETTER}|['’·-](?={_LETTER}))*+)"
_NAME = rf"{_PART}(?:[\s_]+{_PART}|(?<=\.){_PART})*+"
_LABEL = re.compile(
    rf"<v\s+(?P<v>[^<>]+)>"
    rf"|[\[【](?P<b>[^\[\]【】]+)[\]】]{_VOICE}\s*[:：]?"
    rf"|(?:^|(?<=[!?…。！？\])）】>*♪—–:：,，])|(?<=\.)(?<!\W[^\W\d_]\.)(?!{_LETTER})|(?<=[\s-]-)|^-)\s*+(?P<c>{_NAME}){_VOICE}\s*+(?:[:：]|--|——)"
)
_SOUND = re.compile(r"\[[^\[\]]*\]|【[^【】]*】|\([^()]*\)|（[^（）]*）|\*[^*]*\*|♪[^♪]*♪|<[^<>]*>|[♪♫♬]")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+")
_FILLER_HAN = re.compile(f"^[{FILLERS_HAN}]+$")
_HESITATION = re.compile(r"(?i)(?<![\w'’])(?:" + "|".join(sorted(FILLERS_LATIN, key=len, reverse=True)) + rf")(?![\w'’])[.…,，]*\s*|(?<![一-鿿])[{FILLERS_HAN}]+(?![一-鿿])[.…,，。]*\s*")


def clean_words(text: str) -> str:
    """The words that remain beside times, sounds and fillers."""
    t = _SOUND.sub(" ", _TIME.sub(" ", text))
    t = _HESITATION.sub(" ", t)
    return re.sub(r"\s+", " ", t.replace(">>", " ")).strip(" —–-")


def has_words(cleaned: str) -> bool:
    return any(not (w.casefold() in FILLERS_LATIN or _FILLER_HAN.match(w)) for w in _WORD.findall(cleaned))


def norm_label(label: str) -> str:
    t = unicodedata.normalize("NFKC", label).replace("_", " ").casefold()
    return re.sub(r"[^\w]+", " ", t).strip()


def read_pieces(text: str) -> list[tuple[str, bool, str, bool, str | None]]:
    """(label or '', whether the label is bracketed, cleaned words, has speech, cleaned words with a name before them) in order."""
    t = _TIME.sub(" ", text)
    out, at, label, bracket, name = [], 0, "", False, ""

    def piece(rest: str) -> None:
        words = clean_words(rest)
        if label or words:
            out.append((label, bracket, words, has_words(words), f"{clean_words(name[:-1])}: {words}".strip() if name and clean_words(name[:-1]) else None))

    for m in _LABEL.finditer(t):
        piece(t[at : m.start()])
        label, bracket, at = norm_label(m["v"] or m["b"] or m["c"]), m["c"] is None, m.end()
        name = "" if bracket else t[m.start("c") : at]
    piece(t[at:])
    return out


def skeleton_keys(name: str) -> list[str]:
    """Phonetic blocks of a normalised name: the whole name in Han script, else consonants and one-letter deletions."""
    if not name.isascii():
        return ["=" + name.replace(" ", "")]
    s = re.sub(r"[aeiou\s\d]", "", name).replace("w", "").replace("y", "")
    s = re.sub(r"(.)\1+", r"\1", s.replace("z", "s").replace("j", "q").replace("c", "s").replace("x", "s"))
    s = re.sub(r"(.)\1+", r"\1", s)
    return sorted({s, *(re.sub(r"(.)\1+", r"\1", s[:i] + s[i + 1 :]) for i in range(len(s)))})


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


def optimal_assignment(cost: np.ndarray) -> np.ndarray:
    """The column of each row in a one-to-one assignment of least total cost (Hungarian algorithm, rows <= columns)."""
    n, m = cost.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    taken, way = np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        taken[0], j = i, 0
        least, done = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=bool)
        while taken[j]:
            done[j] = True
            free = np.flatnonzero(~done[1:]) + 1
            reduced = cost[taken[j] - 1, free - 1] - u[taken[j]] - v[free]
            better = reduced < least[free]
            least[free[better]], way[free[better]] = reduced[better], j
            nxt = free[int(np.argmin(least[free]))]
            step = least[nxt]
            u[taken[done]] += step
            v[done] -= step
            least[free] -= step
            j = nxt
        while j:
            taken[j], j = taken[way[j]], way[j]
    out = np.zeros(n, dtype=int)
    for j in range(1, m + 1):
        if taken[j]:
            out[taken[j] - 1] = j - 1
    return out


def assignment_cost(label: str, name: str) -> int:
    """Least total edits when the parts of the label are assigned one to one to the parts of the name, or both are read as one word.

    A part left over costs its letters.
    """
    a, b = sorted((label.split(), name.split()), key=len)
    whole = _edits("".join(label.split()), "".join(name.split()))
    if not whole or len(b) == 1:
        return whole
    cost = np.array([[_edits(x, y) for y in b] for x in a] + [[len(y) for y in b]] * (len(b) - len(a)), dtype=float)
    return min(whole, int(cost[np.arange(len(b)), optimal_assignment(cost)].sum()))


def assign_labels(pairs: pd.DataFrame) -> dict[str, str]:
    """The person of each label that is settled, from near pairs (label, variant, person, cost) of one group.

    Labels go to forms of names (variants) at least total edits; of equal totals, the one in which the fewest labels share a
    form holds, so a slip between two names belongs to the one that is not spelt out elsewhere. A label that another person
    would serve at the same total is not settled. Components of labels with common forms are solved apart.
    """
    pairs = pairs.sort_values(["label", "variant", "person"])
    near: dict[str, dict[tuple[str, str], int]] = {}
    for x, variant, person, cost in pairs[["label", "variant", "person", "cost"]].itertuples(index=False):
        near.setdefault(x, {})[person, variant] = int(cost)
    out: dict[str, str] = {}
    # A label's own forms are those of least cost: a form holds any number of labels, so no label has to yield to another.
    least = {x: {f: c for f, c in of.items() if c == min(of.values())} for x, of in near.items()}
    parent = {f: f for of in least.values() for f in of}

    def root(f: tuple[str, str]) -> tuple[str, str]:
        while parent[f] != f:
            parent[f] = parent[parent[f]]
            f = parent[f]
        return f

    for of in least.values():
        first, *rest = of
        for f in rest:
            parent[root(f)] = root(first)
    members: dict[tuple[str, str], list[str]] = {}
    for x, of in least.items():
        members.setdefault(root(next(iter(of))), []).append(x)
    for labels in members.values():
        if all(len({p for p, _ in least[x]}) == 1 for x in labels):
            out |= {x: next(iter(least[x]))[0] for x in labels}
            continue
        forms = sorted({f for x in labels for f in least[x]})
        n = len(labels)
        # Column (form, k) is the form's k-th label: each further one costs more, but less than an edit.
        cost = np.full((n, n * len(forms)), 1e6)
        for i, x in enumerate(labels):
            for f, c in least[x].items():
                cost[i, forms.index(f) * n : (forms.index(f) + 1) * n] = c + np.arange(n) / (n * n + 1)
        best = optimal_assignment(cost)
        total = cost[np.arange(n), best].sum()
        for i, x in enumerate(labels):
            person = forms[best[i] // n][0]
            if len({p for p, _ in least[x]}) > 1:
                other = cost.copy()
                for k, f in enumerate(forms):
                    if f[0] == person:
                        other[i, k * n : (k + 1) * n] = 1e6
                if other[np.arange(n), optimal_assignment(other)].sum() <= total + 1e-9:
                    continue
            out[x] = person
    return out


def resolve_labels(labels: DataFrame, roster: DataFrame) -> DataFrame:
    """Columns g, label, speaker for the distinct (g, label) of ``labels`` that an assignment to the roster settles.

    ``roster`` has g, canonical, variant. Only pairs that share a phonetic block are compared. A group's near pairs, spellings
    within two edits of its roster, are assigned in one task: their number is bounded by the roster, not by the transcripts.
    """

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.assign(block=b["name"].map(skeleton_keys)).explode("block")
            yield b[["g", "name", "who", "block"]]

    norm = F.pandas_udf(lambda s: s.map(lambda x: norm_label(x) if x is not None else None), "string")
    kind = dict(labels.dtypes)["g"]
    left = labels.select("g", F.col("label").alias("name"), F.lit("").alias("who")).distinct().mapInPandas(blocks, f"g {kind}, name string, who string, block string")
    people = roster.select("g", norm(F.col("variant")).alias("name"), F.col("canonical").alias("who")).filter("name is not null and name <> '' and who is not null").distinct()
    right = people.mapInPandas(blocks, f"g {kind}, name string, who string, block string").select("g", "block", F.col("name").alias("variant"), F.col("who").alias("person"))

    parts = F.pandas_udf(lambda a, b: pd.Series([assignment_cost(x, y) for x, y in zip(a, b)]), "int")
    pairs = left.select("g", "block", F.col("name").alias("label")).join(right, ["g", "block"]).select("g", "label", "variant", "person").distinct()
    size = F.length(F.regexp_replace("label", " ", ""))
    # Two single words are compared in the JVM; a pair whose letters are too unlike in number is not near in any order.
    close = F.abs(size - F.length(F.regexp_replace("variant", " ", ""))) <= 2
    several = F.col("label").contains(" ") | F.col("variant").contains(" ")
    pairs = pairs.filter(close)
    one = pairs.filter(~several).withColumn("cost", F.levenshtein("label", "variant"))
    costed = one.unionByName(pairs.filter(several).withColumn("cost", parts("label", "variant")))
    near = costed.filter((F.col("cost") == 0) | (F.col("cost") <= 2) & (F.col("cost") * 4 <= size))

    def settle(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        done = assign_labels(b)
        return pd.DataFrame({"g": [key[0]] * len(done), "label": list(done), "speaker": list(done.values())})

    return near.groupBy("g").applyInPandas(settle, f"g {kind}, label string, speaker string")


def segment_pieces(segments: DataFrame) -> DataFrame:
    """Pieces (g, ep, id, shard, no, label, bracket, words, speech, whole, dead) of segments (g, ep, id, text, risky, words)."""
    columns = ["g", "ep", "id", "shard", "no", "label", "bracket", "words", "speech", "whole", "dead"]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for g, ep, i, shard, text, dead in b.itertuples(index=False):
                for no, (label, bracket, words, speech, whole) in enumerate(read_pieces(text) if isinstance(text, str) else []):
                    rows.append((g, ep, i, shard, no, label, bracket, words, speech, whole, dead))
            yield pd.DataFrame(rows, columns=columns)

    doubtful = F.coalesce(F.col("risky"), F.lit(False)) & F.coalesce(F.size("words") > 0, F.lit(False)) & F.coalesce(F.forall("words", lambda w: F.coalesce(w["low_confidence"], F.lit(False))), F.lit(False))
    rows = segments.filter("ep is not null and id is not null").withColumn("shard", F.expr(f"cast(floor(id / {SHARD_IDS}D) as bigint)"))
    rows = rows.select("g", "ep", "id", "shard", "text", doubtful.alias("dead"))
    return distinct_in_shard(rows, ["ep", "shard"], ["ep", "id"]).mapInPandas(pieces, "g string, ep string, id long, shard long, no int, label string, bracket boolean, words string, speech boolean, whole string, dead boolean")


def attributed(segments: DataFrame, roster: DataFrame) -> DataFrame:
    """Pieces with speech and their speaker: (ep, shard, id, no, speaker, words)."""
    pieces = cut(segment_pieces(segments))  # read by both scans below
    known = resolve_labels(pieces.filter("label <> ''").select("g", "label"), roster)
    named = _null_safe_join(pieces, known, ["g", "label"])
    # An unresolved bracket was a sound; an unresolved name before a colon is part of the speech. Invented speech stays none.
    open_name = (F.col("label") != "") & ~F.col("bracket") & F.col("speaker").isNull()
    named = named.withColumn("speech", ~F.col("dead") & (F.col("speech") | open_name & ~F.col("label").isin(*FILLERS_LATIN)))
    named = named.withColumn("words", F.when(open_name, F.coalesce("whole", "words")).otherwise(F.col("words"))).drop("whole", "dead")
    carried = fill_before(named, ["ep"], "shard", ["id", "no"], F.col("speaker"), "earlier")
    return carried.filter("speech").select("ep", "shard", "id", "no", F.coalesce("speaker", "earlier").alias("speaker"), "words")


def speaker_turns(segments: DataFrame, roster: DataFrame) -> DataFrame:
    """Columns ep, first_id, last_id, speaker: longest runs of speech by one person in order of id."""
    spoken = cut(attributed(segments, roster).filter("speaker is not null").drop("words"))
    before = fill_before(spoken, ["ep"], "shard", ["id", "no"], F.struct("speaker", "id"), "prev")
    starts = before.filter(F.col("prev").isNull() | (F.col("prev.speaker") != F.col("speaker"))).select("ep", "shard", "id", "no", "speaker", F.col("prev.id").alias("prev_id"))
    linked = lead_over(starts, ["ep"], "shard", ["id", "no"], F.col("prev_id"), "last_id")
    final = spoken.groupBy("ep").agg(F.max("id").alias("end_id"))
    out = _null_safe_join(linked, final, ["ep"])
    return out.select("ep", F.col("id").alias("first_id"), F.coalesce("last_id", "end_id").alias("last_id"), "speaker")
