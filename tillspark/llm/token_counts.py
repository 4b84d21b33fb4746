"""Word-piece lengths by a linear longest-match automaton.

Greedy longest-match word-piece tokenisation needs only one pass over a word: a trie of the vocabulary with failure links tells,
where no edge fits, which node the rest of the match continues from, and how many pieces are settled by going there. Those counts
are computed with the links, so a word's length in pieces comes out without building a piece. Two tries are joined by the links:
one of pieces that begin a word, one of pieces that continue it.

Words are maximal runs of letters, digits, marks and underscores; every other character that isn't white space is a word by
itself. A word that the vocabulary can't spell is one unknown token. A null or empty text has no words and no tokens; texts are
read whole, words of any length included. A null id is carried like any other. Repeated rows are counted alike, ties don't arise (the longest match is unique), other
columns are ignored and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, small_batches, text_or_empty, tidy, worker_slot

WORDS = re.compile(r"\w+|[^\w\s]")
#: What a worker remembers of runs between white space with their counts.
CACHE_BYTES = 24 << 20


class PieceAutomaton:
    """starts: pieces that begin a word; continues: pieces that go on within it."""

    def __init__(self, starts: Iterable[str], continues: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]  # nodes 0 and 1: the roots
        self.link: list[int] = [-1, -1]
        self.pops: list[int] = [0, 0]
        final: set[int] = set()
        for root, pieces in ((0, starts), (1, continues)):
            for piece in pieces:
                if not piece:
                    continue
                node = root
                for c in piece:
                    to = self.edges[node].get(c)
                    if to is None:
                        to = self.edges[node][c] = len(self.edges)
                        self.edges.append({})
                        self.link.append(-1)
                        self.pops.append(0)
                    node = to
                final.add(node)
        queue = deque((0, 1))
        while queue:
            u = queue.popleft()
            for c, v in self.edges[u].items():
                if v in final:
                    self.link[v], self.pops[v] = 1, 1
                else:
                    z, popped = self.link[u], self.pops[u]
                    while z >= 0 and c not in self.edges[z]:
                        popped += self.pops[z]
                        z = self.link[z]
                    if z >= 0:
                        self.link[v], self.pops[v] = self.edges[z][c], popped
                queue.append(v)

    def pieces(self, word: str) -> int:
        """Pieces of the greedy longest match, or 0 if there is none."""
        edges, link, pops = self.edges, self.link, self.pops
        node = count = 0
        for c in word:
            while (to := edges[node].get(c)) is None:
                count += pops[node]
                node = link[node]
                if node < 0:
                    return 0
            node = to
        while node != 1:  # settle what the last match left, as a character that fits nowhere would
            count += pops[node]
            node = link[node]
            if node < 0:
                return 0
        return count


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """(starts, continues) of a sentencepiece model: pieces with its word mark begin words; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    mark = "▁"
    return [p[1:] for p in pieces if p.startswith(mark) and mark not in p[1:] and len(p) > 1], [p for p in pieces if mark not in p]


class Counter:
    def __init__(self, automaton: PieceAutomaton):
        self.automaton = automaton
        self.runs = Remembered(CACHE_BYTES)

    def _run(self, run: str) -> tuple[int, int, int]:
        found = [self.automaton.pieces(word) for word in WORDS.findall(run)]
        return len(found), sum(n or 1 for n in found), found.count(0)

    def counts(self, texts: list[str] | pa.Array) -> np.ndarray:
        """Words, tokens and unknown words of each text; no word reaches over white space, so its runs are counted once."""
        self.runs.trim()
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = lists.flatten().dictionary_encode()
        at = self.runs.find(coded.dictionary)
        if (at < 0).any():
            new = coded.dictionary.filter(pa.array(at < 0))
            each = np.array([self._run(run) for run in new.to_pylist()], "<u4")
            self.runs.add(new, each.ravel(), np.full(len(new), 3))
            at = self.runs.find(coded.dictionary)
        of_run = self.runs.numbers.reshape(-1, 3)[at[coded.indices.to_numpy()]]
        sums = np.zeros((len(of_run) + 1, 3), np.int64)
        np.cumsum(of_run, axis=0, out=sums[1:])
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return sums[ends[1:]] - sums[ends[:-1]]


def load(path: str) -> Counter:
    return worker_slot(("token_counts", path), lambda: Counter(PieceAutomaton(*sentencepiece_vocabulary(path))))


def token_counts(docs: DataFrame, *, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown per row."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(vocabulary)
        for b in small_batches(batches, ["text"], 2 << 20):
            found = counter.counts(b.column("text"))
            columns = [b.column("doc_id"), *(pa.array(np.ascontiguousarray(found[:, k])) for k in range(3))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
