"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds a bounded sample of labelled text.
A document is parsed against each: the longest match with the sample is one
phrase, and the next phrase starts where it ends.  The language whose sample
explains the text with the fewest phrases, normalised by the sample's length
(``phrases * log2(sample) / letters``), wins.

Every letter of any sample is a symbol of its own.  An automaton's transitions are
one row of cells, in which the edges of all states are laid between each other (a
cell knows whose edge it holds), so no table of states by letters is made.  A task
walks thousands of text blocks through it in step: a text costs a few table reads a
letter, whatever its length.  Texts are folded to lower-case letters with one space
between runs of letters and cut into blocks of ``BLOCK`` symbols; a block starts a
new phrase, which adds the same to every language.

Only the sample is bounded (``DOCS_PER_LANGUAGE`` documents, a slice of
``SLICE`` letters each); every document is parsed whole.

Edge cases: a null text or one without letters is ``und`` with score 0; a
letter a language's sample lacks ends a phrase and counts as two, an escape and
the letter; ties go to the smaller language name; without
any labelled row everything is ``und``; rows with null lang teach nothing;
repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out

DOCS_PER_LANGUAGE = 200
SLICE = 160
BLOCK = 1024
LANES = 8192               # blocks walked in step
TRIES = 64                 # free cells tried for a state's edges before the end of the row
TEMPERATURE = 0.05         # of the score, in bits a letter
UNDETERMINED = "und"

RESULT = "doc_id long, held_out boolean, lang_pred string, score double, letters long"


def fold(text: str) -> np.ndarray:
    """Code points of the lower-case letters, runs of anything else as one space; trimmed."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _is_letter()[code]
    code = np.where(letter, code, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]                    # a space stays only right after a letter
    code = code[keep]
    return code[:-1] if len(code) and code[-1] == 32 else code


_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Of each state of the automaton of all substrings, the state each symbol leads to."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


def lay_out(edges: list[dict[int, int]], alphabet: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each state, owner, target): the edge of a state at place ``p`` by symbol ``c`` is in
    cell ``p + c``, which ``owner`` says is the state's by the same ``p``.  Places differ."""
    # cells start at ``alphabet``, so no place is negative
    room = 2 * alphabet + 2 * sum(map(len, edges))
    used, place, taken = bytearray(room), [0] * len(edges), set()
    free, top = alphabet, alphabet           # the first free cell, and the end of the row
    for state in sorted(range(len(edges)), key=lambda s: (-len(edges[s]), s)):
        out = sorted(edges[state])
        cell = free = used.find(0, free)
        for left in range(TRIES, -1, -1):
            cell = cell if left else top
            at = cell - out[0] if out else cell
            if at not in taken and not any(used[at + c] for c in out):
                break
            cell = used.find(0, cell + 1)
        while at in taken:                   # only past the end, or without edges: a place of its own
            at += 1
        taken.add(at)
        place[state] = at
        for c in out:
            used[at + c] = 1
        top = max(top, at + out[-1] + 1 if out else 0)
        if top + 2 * alphabet > len(used):
            used.extend(bytes(top + 2 * alphabet - len(used) + room // 4))
    places = np.array(place, dtype=np.int32)
    size = max(place) + alphabet
    owner, target = np.full(size, -1, dtype=np.int32), np.zeros(size, dtype=np.int32)
    for state, row in enumerate(edges):
        for c, to in row.items():
            owner[place[state] + c] = place[state]
            target[place[state] + c] = place[to]
    return places, owner, target


class Model:
    """Automata by language, over one alphabet (symbol 0 is any letter no sample has)."""

    def __init__(self, samples: dict[str, list[np.ndarray]]):
        self.languages = sorted(samples)
        every = np.concatenate([x for s in samples.values() for x in s]) if samples else np.zeros(0, np.uint32)
        points = np.unique(every)
        self.symbol = np.zeros(0x110000, dtype=np.int32)
        self.symbol[points] = np.arange(1, len(points) + 1)
        alphabet, limit = len(points) + 2, len(points) + 1          # the last symbol parts the slices
        self.rows, self.bits = [], []
        for lang in self.languages:
            text = np.concatenate([np.append(self.symbol[x], limit) for x in samples[lang]])
            edges = suffix_automaton(text.tolist())
            # the last state is between phrases: at a block's begin, and after a letter not in the sample
            between = len(edges)
            edges.append({})
            place, owner, target = lay_out(edges, alphabet)
            start = np.full(alphabet, place[between], dtype=np.int32)   # past the end of a phrase, the next one's state
            for c, to in edges[0].items():
                start[c] = place[to]
            self.rows.append((owner, target, start, int(place[between])))
            self.bits.append(float(np.log2(max(len(text), 2))))

    def phrases(self, blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """phrases[language, block]; ``blocks`` is (symbol place, block), longest block first."""
        out = np.zeros((len(self.languages), len(lengths)), dtype=np.int64)
        alive = np.searchsorted(-lengths, -np.arange(1, len(blocks) + 1), side="right")
        for k, (owner, target, start, between) in enumerate(self.rows):
            state = np.full(len(lengths), between, dtype=np.int32)
            count = np.zeros(len(lengths), dtype=np.int32)
            for t, n in enumerate(alive.tolist()):
                if not n:
                    break
                symbol = blocks[t, :n]
                cell = state[:n] + symbol
                ends = owner[cell] != state[:n]
                state[:n] = np.where(ends, start[symbol], target[cell])
                count[:n] += ends
                count[:n] += state[:n] == between          # a letter not in the sample
            out[k] = count
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(bits a letter [language, text], letters): cross-parsing entropy of each text."""
        folded = [self.symbol[fold(t)] if t else np.zeros(0, np.int32) for t in texts]
        size = np.array([len(x) for x in folded], dtype=np.int64)
        n_blocks = -(-size // BLOCK)
        owner = np.repeat(np.arange(len(texts)), n_blocks)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        length = np.minimum(size[owner] - at * BLOCK, BLOCK)
        order = np.argsort(-length, kind="stable")
        total = np.zeros((len(self.languages), len(texts)), dtype=np.int64)
        for b in range(0, len(order), LANES):
            lane = order[b:b + LANES]
            matrix = np.zeros((len(lane), BLOCK), dtype=np.int32)
            for row, (o, a) in enumerate(zip(owner[lane].tolist(), at[lane].tolist())):
                piece = folded[o][a * BLOCK:(a + 1) * BLOCK]
                matrix[row, :len(piece)] = piece
            counts = self.phrases(np.ascontiguousarray(matrix.T), length[lane])
            for k in range(len(self.languages)):
                np.add.at(total[k], owner[lane], counts[k])
        bits = np.array(self.bits)[:, None]
        return total * bits / np.maximum(size, 1)[None, :], size


def sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, letters: int = SLICE) -> dict[str, list[np.ndarray]]:
    """Slices of labelled text by language, from at most ``per_language`` documents each:
    the first by hash among a draw whose rate follows the language's count."""
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    rate = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * per_language / n))])
    order = F.xxhash64(F.col("doc_id"), F.lit("language"))
    drawn = rows.where(F.pmod(order, F.lit(1 << 30)) < rate[F.col("lang")] * float(1 << 30))
    # a slice of the text from a hashed place, long enough to leave ``letters`` letters
    span = 2 * letters
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("slice")), F.greatest(F.length("text") - span, F.lit(1))) + 1
    got = drawn.select("lang", order.alias("o"), F.substring("text", place.cast("int"), F.lit(span)).alias("t")).collect()
    out: dict[str, list[np.ndarray]] = {}
    for lang, _, text in sorted(got, key=lambda r: (r[0], r[1], r[2])):
        piece = fold(text)[:letters]
        if len(piece) and len(out.setdefault(lang, [])) < per_language:
            out[lang].append(piece)
    return {lang: s for lang, s in out.items() if s}


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, letters of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                texts = part.column("text").to_pylist()
                if not model.languages:
                    lang, score, size = [UNDETERMINED] * len(texts), [0.0] * len(texts), np.zeros(len(texts), np.int64)
                else:
                    h, size = model.entropies(texts)
                    best = h.argmin(axis=0)
                    weight = np.exp(-(h - h.min(axis=0)) / TEMPERATURE)
                    p = 1 / weight.sum(axis=0)
                    lang = [model.languages[k] if n else UNDETERMINED for k, n in zip(best, size)]
                    score = np.where(size > 0, p, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()),
                     pa.array(score, pa.float64()), pa.array(size, pa.int64())],
                    names=["doc_id", "held_out", "lang_pred", "score", "letters"])

    return rows.mapInArrow(run, RESULT)


def _pieces(batch: pa.RecordBatch, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes."""
    begin, size = 0, 0
    for k, n in enumerate(pa.compute.binary_length(batch.column("text")).to_pylist()):
        size += n or 0
        if size >= limit:
            yield batch.slice(begin, k + 1 - begin)
            begin, size = k + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, Model(sample(docs.select("doc_id", "lang", "text"))))
