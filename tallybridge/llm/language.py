"""Language spans of whole texts: script ranges, per-word scores, and a path through them."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Sent, by_batch, kept

GRAM_BITS = 15
GRAMS = 1 << GRAM_BITS
# The part of a language's grams that is spread evenly: what it has never shown costs the same in all.
UNSEEN = 0.02
# Natural logarithms by which the words of a span must be better than the language before.
SWITCH = 10.0
# A language takes part in a script that at least this share of its letters is written in.
SCRIPT_SHARE = 0.01
CHARS = 1 << 20
WORDS = 1 << 20
UNKNOWN = "und"

# First and last code point of the blocks of each script.
SCRIPTS = {
    "Latin": [(0x0041, 0x02AF), (0x0300, 0x036F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "Greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x0530, 0x058F)],
    "Hebrew": [(0x0590, 0x05FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x0900, 0x097F)],
    "Bengali": [(0x0980, 0x09FF)],
    "Gurmukhi": [(0x0A00, 0x0A7F)],
    "Gujarati": [(0x0A80, 0x0AFF)],
    "Tamil": [(0x0B80, 0x0BFF)],
    "Telugu": [(0x0C00, 0x0C7F)],
    "Kannada": [(0x0C80, 0x0CFF)],
    "Malayalam": [(0x0D00, 0x0D7F)],
    "Sinhala": [(0x0D80, 0x0DFF)],
    "Thai": [(0x0E00, 0x0E7F)],
    "Lao": [(0x0E80, 0x0EFF)],
    "Tibetan": [(0x0F00, 0x0FFF)],
    "Burmese": [(0x1000, 0x109F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "Ethiopic": [(0x1200, 0x139F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS)
PLANE = 1 << 16


class Characters:
    """By code point of the first plane: lower case, letter, part of a word, script."""

    def __init__(self):
        names = [chr(c) for c in range(PLANE)]
        lower = [n.lower() for n in names]
        self.lower = np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(lower)], np.uint32)
        kinds = [unicodedata.category(n)[0] for n in names]
        self.letter = np.array([k == "L" for k in kinds])
        self.word = np.array([k in "LM" for k in kinds])
        ranges = sorted((a, b, n) for n, blocks in enumerate(SCRIPTS.values()) for a, b in blocks)
        self.starts, self.ends, self.names = (np.array(x, np.int64) for x in zip(*ranges, strict=True))
        self.script = self.find_script(np.arange(PLANE))

    def find_script(self, points: np.ndarray) -> np.ndarray:
        at = np.maximum(np.searchsorted(self.starts, points, side="right") - 1, 0)
        return np.where((points >= self.starts[at]) & (points <= self.ends[at]), self.names[at], OTHER).astype(np.int16)

    def of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        near = np.minimum(points, PLANE - 1)
        lower, letter, word, script = self.lower[near], self.letter[near], self.word[near], self.script[near]
        far = np.flatnonzero(points >= PLANE)
        if len(far):
            lower[far], script[far] = points[far], self.find_script(points[far].astype(np.int64))
            unique, back = np.unique(points[far], return_inverse=True)
            kinds = np.array([unicodedata.category(chr(c))[0] for c in unique.tolist()])[back]
            letter[far], word[far] = kinds == "L", np.isin(kinds, ["L", "M"])
        return lower, letter, word, script


class Words:
    """The words of a list of texts: runs of letters and marks of one script with a letter in them.

    ``text``, ``start``, ``letters`` and ``script`` per word; ``gram`` and ``of`` per letter or mark: the hash of it
    with its neighbours in the word, and its word.
    """

    def __init__(self, texts: list[str]):
        about: Characters = kept("characters", Characters)
        joined = "\n".join([*texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begins = np.cumsum(lengths) - lengths
        lower, letter, word, script = about.of(points)
        inside = np.zeros(len(points) + 2, bool)
        inside[1:-1] = word
        change = np.ones(len(points) + 1, bool)
        change[1:-1] = script[1:] != script[:-1]
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | change[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | change[1:])) + 1
        size = ends - starts
        counted = np.concatenate([[0], np.cumsum(letter)])
        letters = counted[ends] - counted[starts]
        good = letters > 0
        starts, ends, size, self.letters = starts[good], ends[good], size[good], letters[good]
        self.text = np.searchsorted(begins, starts, side="right") - 1
        self.start = starts - begins[self.text]
        self.size, self.script = size, script[starts]
        self.of = np.repeat(np.arange(len(size)), size)
        first = np.cumsum(size) - size
        at = starts[self.of] + np.arange(len(self.of)) - first[self.of]
        here = lower[at].astype(np.uint64)
        before = np.where(at > starts[self.of], lower[np.maximum(at - 1, 0)], 0).astype(np.uint64)
        after = np.where(at + 1 < ends[self.of], lower[np.minimum(at + 1, len(lower) - 1)], 0).astype(np.uint64)
        mixed = (before << np.uint64(42) | here << np.uint64(21) | after) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        self.gram = (mixed >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def portions(texts: list[str | None]) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """(row, place in it, piece) lists of about CHARS code points; a longer text comes in pieces
    that end after a blank where the last 4,096 signs of a piece have one."""
    rows, places, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        at, text = 0, text or ""
        while at < len(text):
            end = at + CHARS
            if end < len(text):
                blank = text.rfind(" ", max(at, end - 4096), end)
                end = blank + 1 if blank > at else end
            rows.append(row)
            places.append(at)
            parts.append(text[at:end])
            size, at = size + len(parts[-1]), end
            if size >= CHARS:
                yield rows, places, parts
                rows, places, parts, size = [], [], [], 0
    if rows:
        yield rows, places, parts


class Model:
    """Log shares of each gram by language, and the scripts each is written in."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        table = np.array([counts[n] for n in self.languages], float).reshape(-1, GRAMS + OTHER + 1)
        grams, scripts = table[:, :GRAMS], table[:, GRAMS:]
        known = grams / np.maximum(grams.sum(1, keepdims=True), 1)
        self.scores = np.ascontiguousarray(np.log((1 - UNSEEN) * known + UNSEEN / GRAMS).T.astype(np.float32))
        share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
        allowed = share.T >= SCRIPT_SHARE
        allowed[~allowed.any(1)] = True  # a script that nobody is written in rules nobody out
        self.barred = np.where(allowed, 0, -1e6).astype(np.float32)

    def word_scores(self, words: Words) -> np.ndarray:
        """One row per word, one column per language."""
        out = np.empty((len(words.size), len(self.languages)), np.float32)
        for n in range(len(self.languages)):
            out[:, n] = np.bincount(words.of, self.scores[words.gram, n], len(words.size))
        return out + self.barred[words.script]


def learn(docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang") -> Model:
    """Counts every gram of every text whose language is not null; the driver gets one number
    per language, gram bucket and script, whatever the input."""
    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text")).dropna()
    schema = "lang string, bucket int, n long"
    kind = docs.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                counts = found.setdefault(lang, np.zeros(GRAMS + OTHER + 1, np.int64))
                for _, _, parts in portions([t for t, own in zip(texts, langs, strict=True) if own == lang]):
                    words = Words(parts)
                    counts[:GRAMS] += np.bincount(words.gram, minlength=GRAMS)
                    counts[GRAMS:] += np.bincount(words.script, words.letters, OTHER + 1).astype(np.int64)
        for lang, counts in found.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(counts[used])], schema=arrow)

    total = rows.mapInArrow(run, kind).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, np.ndarray] = {}
    for lang, bucket, n in zip(*(total[c].to_pylist() for c in ("lang", "bucket", "n")), strict=True):
        counts.setdefault(lang, np.zeros(GRAMS + OTHER + 1))[bucket] = n
    return Model(counts)


def best_paths(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of every word: per text, the path with the best sum of word scores less
    ``switch`` for each change (Viterbi). All texts advance a word at a time together, the
    long ones last; ties stay with the language before, else take the first."""
    label = np.zeros(len(scores), np.int64)
    order = np.argsort(-sizes, kind="stable")
    begin = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    texts = int((sizes > 0).sum())
    if not texts or not scores.shape[1]:
        return label
    came = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32)
    value = scores[begin[:texts]].astype(np.float64)
    own = np.arange(scores.shape[1])
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")  # texts with at least so many words
    for t in range(1, int(sizes[0])):
        n = active[t]
        now = value[:n]
        best = now.argmax(1)
        changed = now[np.arange(n), best] - switch
        stay = now >= changed[:, None]
        at = begin[:n] + t
        came[at] = np.where(stay, own, best[:, None])
        value[:n] = np.where(stay, now, changed[:, None]) + scores[at]
    state = value.argmax(1)
    for t in range(int(sizes[0]) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        label[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return label


def identify(docs: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row's doc_id, lang_pred, score and spans (lang, start, end in code points).

    ``lang_pred`` is the language with most letters, the first of equal ones, and ``score`` its
    share of the letters. A text that is null or has no letter, or any text if nothing was
    learned, is ``und`` with score 0 and no spans. Repeated rows are judged each, extra columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    sent = Sent(docs.sparkSession, model)  # bounded: languages * buckets

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        model, n = sent.value, batch.num_rows
        ids, out = batch.column(0), 0
        texts = batch.column(1).to_pylist()
        gathered: list[tuple[np.ndarray, ...]] = []
        count = 0

        def label(upto: int) -> dict:
            nonlocal gathered, count, out
            row, start, size, letters, scores = (
                (np.concatenate([g[i] for g in gathered]) for i in range(5)) if gathered
                else (np.empty(0, np.int64),) * 4 + (np.empty((0, len(model.languages))),)
            )
            found = labelled(model.languages, row - out, start, size, letters, scores, upto - out)
            result = {"doc_id": ids[out:upto]} | found
            gathered, count, out = [], 0, upto
            return result

        for rows, places, parts in portions(texts):
            if count >= WORDS and rows[0] > out and not any((g[0] >= rows[0]).any() for g in gathered):
                yield label(rows[0])
            words = Words(parts)
            own = np.array(rows, np.int64)[words.text]
            gathered.append((own, np.array(places, np.int64)[words.text] + words.start, words.size, words.letters, model.word_scores(words)))
            count += len(own)
        yield label(n)

    return by_batch(rows, "doc_id long, lang_pred string, score double, spans array<struct<lang: string, start: int, end: int>>", run)


def labelled(languages: list[str], row: np.ndarray, start: np.ndarray, size: np.ndarray, letters: np.ndarray, scores: np.ndarray, rows: int) -> dict:
    """lang_pred, score and spans of ``rows`` texts from their words, which come in order."""
    k = len(languages)
    if not k:
        return {"lang_pred": [UNKNOWN] * rows, "score": np.zeros(rows), "spans": [[]] * rows}
    path = best_paths(scores, np.bincount(row, minlength=rows))
    weight = np.bincount(row * k + path, letters, rows * k).reshape(rows, k)
    total, best = weight.sum(1), weight.argmax(1)
    score = np.where(total > 0, weight[np.arange(rows), best] / np.maximum(total, 1), 0)
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(path) != 0)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(row)) - 1 if len(head) else head
    spans: list[list] = [[] for _ in range(rows)]
    for r, p, a, b in zip(row[head].tolist(), path[head].tolist(), start[head].tolist(), (start + size)[tail].tolist(), strict=True):
        spans[r].append({"lang": languages[p], "start": a, "end": b})
    names = [languages[b] if t else UNKNOWN for b, t in zip(best.tolist(), (total > 0).tolist(), strict=True)]
    return {"lang_pred": names, "score": score, "spans": spans}
