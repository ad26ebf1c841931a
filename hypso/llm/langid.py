"""Language ID by cross-parsing entropy.

For each language, a suffix automaton of labelled text recognises exactly the strings that occur in it. Texts are seen
as the UTF-8 bytes of their lower-case letters, with one symbol for each run of other characters, so every script is
told apart and no letter is left out. A text is parsed greedily into phrases, each the longest match from its position
(the automaton's walk from its root until no transition fits). A phrase costs log2(size of the language's text) bits
for its place and CODE bits for its length and what follows; a byte that no phrase can begin with costs LITERAL bits in
any language. The language with the fewest bits, its phrases thus normalised, wins. Walks of many text segments and all
languages go side by side in NumPy, one byte a step.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import held, held_out, text_column

#: Bounds of the sample that is learned from. Characters of one language and of all: with more languages than
#: MAX_TOTAL / MAX_CHARS, each gives less. Documents looked at for each. Labels: of more, the most frequent are learned.
MAX_CHARS, MAX_TOTAL, MAX_DOCS, MAX_LANGS = 30_000, 400_000, 64, 4096
LEAST_CHARS = 200
#: What one text gives before all others have given as much: one part in so many.
SHARES = 8
#: A parse starts anew after so many bytes, so that long texts are parsed side by side.
SEGMENT = 2048
CODE, LITERAL = 8.0, 24.0
UNKNOWN_LANG = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def symbols(text: str) -> np.ndarray:
    """The bytes of a text's letters, lower case, and 0 for each run of other characters."""
    low = text.lower()
    raw = np.frombuffer(low.encode("utf-8", "surrogatepass"), np.uint8)
    if low.isascii():
        there = letters()[:128][raw]
    else:
        points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        there = np.repeat(letters()[points], 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
    codes = np.where(there, raw, 0).astype(np.uint8)
    keep = there.copy()
    keep[1:] |= there[:-1]
    if len(keep):
        keep[0] = True
    return codes[keep]


def automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a symbol sequence; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, size = [-1], [0]
    last = 0
    for s in sequence:
        new = len(moves)
        moves.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


def compact(sample: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """A sample's size in symbols, and its automaton as transitions a state, their symbols and their targets."""
    codes = symbols(sample)
    moves = automaton(codes.tolist())
    n = sum(map(len, moves))
    return (
        len(codes), np.fromiter(map(len, moves), np.uint8, len(moves)),
        np.fromiter((s for m in moves for s in m), np.uint8, n), np.fromiter((q for m in moves for q in m.values()), np.int32, n),
    )


class Model:
    """All languages' automata in one table of total transition functions.

    An entry holds the state that a symbol leads to (as the offset of its row) and, in its two lowest bits, what it
    adds: 1 a phrase that ended before the symbol, 2 a literal. Where no transition fits, the walk goes on from the
    root. So a step is two look-ups, whether phrases end or not. A row is as wide as its language has symbols, plus
    one entry for all other bytes.
    """

    def __init__(self, automata: dict[str, tuple]):
        self.langs = sorted(automata)
        k = len(self.langs)
        self.column = np.zeros((k, 256), np.int32)  # 0: a byte that the language's text doesn't have
        self.root, self.bits = np.zeros(k, np.int32), np.zeros(k)
        tables, base = [], 0
        for i, lang in enumerate(self.langs):
            size, counts, signs, targets = automata[lang]
            own = np.unique(signs)
            self.column[i, own] = np.arange(1, len(own) + 1)
            wide = len(own) + 1
            state = np.repeat(np.arange(len(counts)), counts)
            to = (base + targets * wide) << 2
            first = np.full(wide, base << 2 | 2, np.int32)  # from the root, a byte that nothing begins with
            begins = self.column[i, signs[: counts[0]]]
            first[begins] = to[: counts[0]]
            table = np.empty((len(counts), wide), np.int32)
            table[:] = first | 1
            table[0] = first
            table[state, self.column[i, signs]] = to
            tables.append(table.ravel())
            self.root[i], self.bits[i] = base, np.log2(max(2, size)) + CODE
            base += table.size
        self.moves = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def parsed(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy phrases, and literals, of each symbol array (at most SEGMENT long) for each language."""
        n, k = len(parts), len(self.langs)
        lengths = np.array([len(p) for p in parts])
        order = np.argsort(-lengths, kind="stable")
        grid = np.zeros((int(lengths.max(initial=0)), n), np.uint8)
        for column, i in enumerate(order.tolist()):
            grid[: lengths[i], column] = parts[i]
        active = np.searchsorted(-lengths[order], -np.arange(len(grid)), "left")  # parts longer than t
        state = np.repeat(self.root[:, None], n, axis=1)
        told = np.zeros((k, n), np.int32)
        adds = np.array([0, 1, 1 << 16, 1 + (1 << 16)], np.int32)
        for t, m in enumerate(active.tolist()):
            to = self.moves[state[:, :m] + self.column[:, grid[t, :m]]]
            told[:, :m] += adds[to & 3]
            state[:, :m] = to >> 2
        told += state != self.root[:, None]
        out = np.zeros((n, k), np.int32)
        out[order] = told.T
        return out & 0xFFFF, out >> 16

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN_LANG] * len(texts), [0.0] * len(texts)
        parts, owner = [], []
        for i, text in enumerate(texts):
            codes = symbols(text) if text else np.zeros(0, np.uint8)
            if codes.any():
                for s in range(0, len(codes), SEGMENT):
                    parts.append(codes[s : s + SEGMENT])
                    owner.append(i)
        if not parts or not self.langs:
            return langs, scores
        own = np.array(owner)
        sizes = np.zeros(len(texts))
        np.add.at(sizes, own, [len(p) for p in parts])
        cost = np.zeros((len(texts), len(self.langs)))
        most = max(1, 4_000_000 // len(self.langs) // SEGMENT)  # segments at once: the work arrays stay small
        for s in range(0, len(parts), most):
            phrases, literals = self.parsed(parts[s : s + most])
            np.add.at(cost, own[s : s + most], phrases * self.bits + literals * LITERAL)
        for i in np.unique(own).tolist():
            bits = cost[i] / sizes[i]
            k = int(np.argmin(bits))
            langs[i] = self.langs[k]
            weigh = np.exp2(np.maximum((bits[k] - bits) * min(sizes[i], 32.0), -1000.0))
            scores[i] = float(1.0 / weigh.sum())
        return langs, scores


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, str]:
    """Labelled texts for each language, in the order of a hash of the id, up to the documented bounds.

    Documents held out and texts that are null or have no letters take no part and aren't counted. A text gives its
    first characters, from its first letter on if it is longer than MAX_CHARS: a share first, and where room is left
    then, more in the same order. Every language has one text at least; of more than MAX_LANGS labels, the most
    frequent are learned.
    """
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & ~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("doc_id")
    mark = F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = known.groupBy("lang").agg(F.count("*").alias("count"), F.min(mark).alias("least")).orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    if not counts:
        return {}
    room = room_for(len(counts))
    # The id with the least mark is in, whatever the hash makes of the others.
    shares = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], max(r["least"], min(1.0, 2.0 * MAX_DOCS / r["count"])))))
    bounded = F.when(F.length("text") > MAX_CHARS, F.substring(F.regexp_replace("text", r"^\P{L}++", ""), 1, MAX_CHARS)).otherwise(F.col("text"))
    few = known.where(mark <= shares[F.col("lang")]).select("lang", bounded.alias("text"), h.alias("h"), "doc_id")
    # A language's first texts, as far as their shares fill its room: what reaches the driver is bounded.
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    few = few.withColumn("r", F.row_number().over(order)).where(F.col("r") <= 4 * MAX_DOCS)
    before = F.coalesce(F.sum(F.least(F.length("text"), F.lit(max(1, room // SHARES)))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    few = few.withColumn("before", before).where(F.col("before") < room)
    texts: dict[str, list[str]] = {}
    for r in few.orderBy("lang", "r").select("lang", F.substring("text", 1, room).alias("text")).collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    return {lang: "\n".join(filled(own, room)) for lang, own in texts.items()}


def room_for(langs: int) -> int:
    """Characters of each language's sample."""
    return max(LEAST_CHARS, min(MAX_CHARS, MAX_TOTAL // max(1, langs)))


def filled(texts: list[str], room: int = MAX_CHARS) -> list[str]:
    """Beginnings of the texts, ``room`` characters in all at most: a share of each first, then the rest in their order."""
    given, whole = [0] * len(texts), room
    for most in (max(1, room // SHARES), whole):
        for i, text in enumerate(texts):
            more = min(len(text), most, given[i] + room) - given[i]
            given[i] += more
            room -= more
    return [t[:n] for t, n in zip(texts, given, strict=True) if n]


def told(samples: dict[str, str], text: Column, docs: DataFrame) -> Column:
    """struct(lang, score) of a text, as ``identify`` has them. The automata are built once and broadcast in compact
    form, bounded by MAX_TOTAL symbols; a worker expands them to a table of its own."""
    shared = docs.sparkSession.sparkContext.broadcast({lang: compact(s) for lang, s in samples.items()})
    name = uuid.uuid4().hex

    def judged(column: pa.Array) -> pa.Array:
        model, texts = held(("langid", name), lambda: Model(shared.value)), column.to_pylist()
        langs: list[str] = []
        scores: list[float] = []
        start, size = 0, 0
        for i in range(len(texts) + 1):
            if i == len(texts) or (size > 1_000_000 and i > start):
                a, b = model.judge(texts[start:i])
                langs += a
                scores += b
                start, size = i, 0
            if i < len(texts):
                size += len(texts[i] or "")
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return text_column(text, "struct<lang string, score double>", judged, docs.sparkSession)


def identify(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score.

    A null text or one without letters gives ``und`` and score 0, as does every text if nothing was learned. A tie
    goes to the first language in alphabetical order. The score is the winner's share of weight 2**-(cost in bits), of
    at most 32 symbols' worth. Whole texts are parsed, in segments; very long ones take more segments. Repeated rows
    and null ids are judged like others; an empty table gives no rows; other columns, whatever their names, play no part.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), told(samples, F.col(text_col), docs).alias("told"))
    return rows.select("doc_id", F.col("told.lang").alias("lang_pred"), F.col("told.score").alias("score"))


def identify_documents(docs: DataFrame) -> DataFrame:
    """Learns from the documents that aren't held out and judges all: doc_id, held_out, lang_pred, score."""
    got = identify(docs, sample(docs, "doc_id", "text", "lang"))
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
