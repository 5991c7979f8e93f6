"""Language identification by cross-parsing: how few phrases of a language's reference text spell a document.

For each language a reference is made of labelled text and indexed by a suffix automaton. A text is parsed greedily into
phrases, each the longest match that the automaton still has; the language that needs the fewest bits wins, where a phrase
costs the logarithm of the reference's length (a place in it), so that references of different lengths compare. Words are parsed
one by one with a space at either end, which lets a worker remember the counts of words it has met; a phrase never crosses
words. New words of a batch are stepped through all automata at once by numpy table lookups.

The references come from a bounded sample: at most ``DOCUMENTS`` different texts per language, picked by hash, of the
``LANGUAGES`` most frequent languages; of their words the ``WORDS`` held by most documents (``ALL_WORDS`` over all languages), without
words longer than ``LONGEST`` letters. A word is left out of a reference where its share of documents is below half of its largest
share in any language, which keeps wrongly labelled documents from spelling another language.

Defined results: a text that is null, empty or has no letter is ``und`` with score 0, as is every text when nothing was learned;
equal costs give the smaller language name; repeated rows get equal results; rows with a null id are predicted too; whole texts
are parsed, very long ones piece by piece; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.llm.common import prepare, staged

DOCUMENTS = 400
LANGUAGES = 64
WORDS = 6000
ALL_WORDS = 48_000
LONGEST = 40
SHARE = 0.5

UNKNOWN = "und"

# words whose counts a worker remembers
REMEMBERED = 400_000

# characters of a text looked at in one go
PIECE = 1 << 20

# letters from which a word is parsed alone and not remembered
ALONE = 64

# words stepped through the automata at once
STEPPED = 50_000

# places a text's hash can have
PLACES = 1 << 30

# how sharply the score follows the difference in bits a letter
SHARPNESS = 6.0

_RUN = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[\W\d_]")


def words_of(text: str) -> Iterator[list[str]]:
    """The words (runs of letters, lower case) of a text, in lists of bounded size unless a single run is longer."""
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            cut = _BREAK.search(text, end)
            end = cut.start() if cut else len(text)
        yield _RUN.findall(text[start:end].lower())
        start = end


def letters_in(word: str) -> int:
    return len(word) if word.isalpha() else sum(map(str.isalpha, word))


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of every state; the first state is the root. Every factor of the text is a path from the root."""
    moves: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for symbol in text:
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at >= 0:
            after = moves[at][symbol]
            if longest[after] == longest[at] + 1:
                link[new] = after
            else:
                copy = len(moves)
                moves.append(dict(moves[after]))
                longest.append(longest[at] + 1)
                link.append(link[after])
                link[after] = link[new] = copy
                while at >= 0 and moves[at].get(symbol) == after:
                    moves[at][symbol] = copy
                    at = link[at]
        last = new
    return moves


@dataclass
class Parser:
    """The automata of all references in one table: row of a state, column of a symbol, 0 where there is no way on."""

    references: dict[str, str]
    names: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.names = sorted(self.references)
        alphabet = sorted(set("".join(self.references.values())) | {" "})
        self.symbol = {c: i + 1 for i, c in enumerate(alphabet)}  # 0: no reference has it
        built = [suffix_automaton([self.symbol[c] for c in self.references[name]]) for name in self.names]
        self.symbols = np.zeros(sys.maxunicode + 1, np.int16)
        self.symbols[[ord(c) for c in alphabet]] = range(1, len(alphabet) + 1)
        self.table = np.zeros((1 + sum(map(len, built)), len(alphabet) + 1), np.int32)
        roots, first = [], 1
        for moves in built:
            roots.append(first)
            for state, out in enumerate(moves, first):
                for symbol, to in out.items():
                    self.table[state, symbol] = first + to
            first += len(moves)
        self.roots = np.array(roots, np.int32)
        self.phrase_bits = np.log2([max(2, len(self.references[name])) for name in self.names])
        self.known: dict[str, int] = {}
        self.counts = np.zeros((1, len(self.names) + 1), np.int32)

    def phrases(self, words: list[str]) -> np.ndarray:
        """(words, languages): phrases that spell each word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        ends = lengths[order] + 2
        width = int(ends.max(initial=0))
        letters = np.frombuffer("".join([f" {words[i]} " for i in order.tolist()]).encode("utf-32-le"), np.uint32)
        spelled = np.zeros((len(words), width), np.int32)
        spelled[np.arange(width) < ends[:, None]] = self.symbols[letters]
        state = np.tile(self.roots, (len(words), 1))
        found = np.zeros(state.shape, np.int32)
        for t in range(width):
            n = int(np.searchsorted(-ends, -t, side="left"))  # words that go on
            symbol, now = spelled[:n, t, None], state[:n]
            after = self.table[now, symbol]
            stuck = after == 0
            # the phrase before ends here, and the symbol begins the next one
            found[:n] += stuck & (now != self.roots)
            again = np.where(stuck, self.table[self.roots[None, :], symbol], after)
            found[:n] += again == 0  # a symbol that the reference lacks is a phrase
            state[:n] = np.where(again == 0, self.roots, again)
        found += state != self.roots
        out = np.empty_like(found)
        out[order] = found
        return out

    def _long(self, word: str) -> np.ndarray:
        """Phrases of a single very long word."""
        spelled = [self.symbol.get(c, 0) for c in f" {word} "]
        out = []
        for root in self.roots.tolist():
            state, n = root, 0
            for symbol in spelled:
                after = int(self.table[state, symbol])
                if not after:
                    n += state != root
                    after = int(self.table[root, symbol])
                    n += not after
                state = after or root
            out.append(n + (state != root))
        return np.array(out)

    def learn(self, words: set[str]) -> None:
        """Remember the counts of these words, as far as they are new."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(words)
        first, last = len(self.known), len(self.known) + len(new)
        if last > len(self.counts):
            self.counts = np.resize(self.counts, (max(last, 2 * len(self.counts)), self.counts.shape[1]))
        for some in range(0, len(new), STEPPED):
            part = new[some : some + STEPPED]
            at = slice(first + some, first + some + len(part))
            self.counts[at, :-1] = self.phrases(part)
            self.counts[at, -1] = [letters_in(w) for w in part]
        self.known.update(zip(new, range(first, last)))

    def _add(self, totals: np.ndarray, pieces: list[tuple[int, list[str]]]) -> None:
        """Add the counts of the pieces, (row, words) each, to the rows of the totals."""
        met = set().union(*(words for _, words in pieces))
        if max(map(len, met), default=0) >= ALONE:
            for row, words in pieces:
                for word in (w for w in words if len(w) >= ALONE):
                    totals[row, :-1] += self._long(word)
                    totals[row, -1] += letters_in(word)
            pieces = [(row, [w for w in words if len(w) < ALONE]) for row, words in pieces]
            met = {w for w in met if len(w) < ALONE}
        self.learn(met)
        for row, words in pieces:
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            totals[row] += self.counts[at].sum(axis=0, dtype=np.int64)

    def totals(self, texts: list[str | None]) -> np.ndarray:
        """Phrases by language, then letters, of each text. Words of about ``PIECE`` characters are learned together."""
        totals = np.zeros((len(texts), len(self.names) + 1), np.int64)
        pieces: list[tuple[int, list[str]]] = []
        size = 0
        for row, text in enumerate(texts):
            for words in words_of(text or ""):
                pieces.append((row, words))
                size += min(PIECE, len(text))
                if size >= PIECE:
                    self._add(totals, pieces)
                    pieces, size = [], 0
        self._add(totals, pieces)
        return totals

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text, and the winner's share of all languages' weights."""
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        totals = self.totals(texts)
        letters = totals[:, -1]
        bits = totals[:, :-1] * self.phrase_bits / np.maximum(1, letters)[:, None]
        best = bits.argmin(axis=1)
        scores = 1 / np.exp2(-SHARPNESS * (bits - bits.min(axis=1, keepdims=True))).sum(axis=1)
        named = [self.names[b] if n else UNKNOWN for b, n in zip(best, letters)]
        return named, np.where(letters > 0, scores, 0.0).tolist()


_parsers: dict[int, Parser] = {}


def parser_of(references: dict[str, str]) -> Parser:
    """One parser per worker and set of references."""
    key = hash(tuple(sorted(references.items())))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(references)
    return _parsers[key]


def fit(
    docs: DataFrame,
    where: Column | None = None,
    documents: int = DOCUMENTS,
    languages: int = LANGUAGES,
    words: int = WORDS,
    text: str = "text",
    lang: str = "lang",
) -> dict[str, str]:
    """{language: reference text}, learned from the rows ``where`` holds; only text and language are looked at."""
    prepare(docs.sparkSession)
    usable = (docs if where is None else docs.where(where)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(13), text).alias("pick")
    )
    usable = usable.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("pick").alias("different"))
    frequent = counts.orderBy(F.desc("n"), "lang").limit(languages).select("lang", "different")
    # about twice the texts wanted, by the place of their hash; equal texts count once
    few = F.pmod("pick", F.lit(PLACES)) * F.col("different") < 2.0 * documents * PLACES
    texts = usable.select("lang", "pick").join(F.broadcast(frequent), "lang").where(few).select("lang", "pick").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("pick"))
    picked = staged(texts.withColumn("rank", rank).where(F.col("rank") <= documents).select("lang", "pick"), "picked")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for l, pick, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held: set[str] = set()
                for piece in words_of(t):
                    held.update(w for w in piece if len(w) <= LONGEST)
                found = sorted(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([l] * len(found), pa.string()), pa.array([pick] * len(found), pa.int64()), pa.array(found, pa.string())],
                    ["lang", "pick", "word"],
                )

    # the picked texts are bounded by ``languages`` and ``documents``
    chosen = usable.join(F.broadcast(picked), ["lang", "pick"]).select("lang", "pick", "text")
    held = chosen.mapInArrow(split, "lang string, pick bigint, word string").distinct()
    shares = held.groupBy("lang", "word").count().join(F.broadcast(picked.groupBy("lang").agg(F.count("*").alias("all"))), "lang")
    shares = shares.withColumn("share", F.col("count") / F.col("all"))
    own = shares.withColumn("most", F.max("share").over(Window.partitionBy("word"))).where(F.col("share") >= SHARE * F.col("most"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), F.xxhash64("word"), "word"))
    rows = own.withColumn("place", place).where(F.col("place") <= words).select("lang", "word", "place").collect()
    each = ALL_WORDS // max(1, len({r.lang for r in rows}))
    by_lang: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.place)):
        if r.place <= each:
            by_lang.setdefault(r.lang, []).append(r.word)
    return {name: f" {' '.join(found)} " for name, found in by_lang.items()}


def predict(docs: DataFrame, references: dict[str, str], id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``lang_pred``, ``score``) of every row; the score is the share of the winner among all languages' weights."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_of(references)
        for batch in batches:
            named, scores = parser.predict(batch.column(1).to_pylist())
            columns = [pa.array(named, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id, "lang_pred", "score"])

    rows = docs.select(id, text)
    return rows.mapInArrow(run, f"`{id}` {rows.schema[id].dataType.simpleString()}, lang_pred string, score double")
