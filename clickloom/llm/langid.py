"""Operator 9: language of texts, and of the spans of mixed texts.

Signs separate words. A word's script, by the ranges of its code points, leaves the languages that were seen in that
script; byte trigrams of the lowered word, with its edges, score each of them (hashed tables of fixed size). Viterbi over the words with a penalty for
each switch labels spans; the language of most letters is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import SPACE, Words, raw, slices
from .toxicity import is_training

SAMPLE, SLOTS, SWITCH, SMOOTH = 1_500, 1 << 16, 8.0, 0.3
_LETTER = regex.compile(r"\p{L}")

# Letters only: signs and digits of ASCII separate words.
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[:128] = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)]
# Blocks of Unicode by script. What lies in none of them is "other"; "sign" separates words.
SCRIPT_RANGES = {
    "sign": ((0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x2000, 0x206F), (0x20A0, 0x20CF), (0x2190, 0x2BFF), (0x3000, 0x3004), (0x3008, 0x3020), (0xFF01, 0xFF20), (0x1F000, 0x1FAFF)),
    "latin": ((0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x2AF), (0x1D00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFE)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "oriya": ((0xB00, 0xB7F),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "sinhala": ((0xD80, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "lao": ((0xE80, 0xEFF),),
    "tibetan": ((0xF00, 0xFFF),),
    "myanmar": ((0x1000, 0x109F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF)),
    "ethiopic": ((0x1200, 0x139F), (0x2D80, 0x2DDF)),
    "khmer": ((0x1780, 0x17FF),),
    "mongolian": ((0x1800, 0x18AF),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "han": ((0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)),
}
SCRIPTS = len(SCRIPT_RANGES) + 1  # 0: other; 1: sign; then in the order above
_RANGES = np.array(sorted((a, b, i + 1) for i, ranges in enumerate(SCRIPT_RANGES.values()) for a, b in ranges), dtype=np.int64)
_SIGN = 1


def scripts(buf: np.ndarray) -> np.ndarray:
    """The script of each character of UTF-8 bytes, at its first byte; signs at all their bytes."""
    out = np.zeros(len(buf) + 3, dtype=np.uint8)
    out[:-3][(buf >= 97) & (buf <= 122)] = 1 + list(SCRIPT_RANGES).index("latin")
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        padded = np.concatenate([buf, np.zeros(3, np.uint8)])
        b0, b1, b2, b3 = (padded[lead + k].astype(np.int32) for k in range(4))
        low = b1 & 63
        mid = low << 6 | b2 & 63
        code = np.where(b0 < 0xE0, (b0 & 31) << 6 | low, np.where(b0 < 0xF0, (b0 & 15) << 12 | mid, (b0 & 7) << 18 | mid << 6 | b3 & 63))
        place = np.maximum(np.searchsorted(_RANGES[:, 0], code, side="right") - 1, 0)
        found = np.where((code >= _RANGES[place, 0]) & (code <= _RANGES[place, 1]), _RANGES[place, 2], 0)
        out[lead] = found
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            out[lead[(found == _SIGN) & (b0 >= least)] + k] = _SIGN
    return out[:-3]


def features(text: pa.StringArray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, slots of the trigrams, where each word's trigrams start among them, and each word's script."""
    data, off = raw(text)
    buf = _TABLE[data]
    script = scripts(buf)
    words = Words.of(buf, off, (buf != SPACE) & (script != _SIGN))
    if not len(words.start):
        return words, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    length = words.end - words.start
    first = np.cumsum(length) - length
    pos = np.repeat(words.start - first, length) + np.arange(length.sum())
    here = buf[pos].astype(np.uint64)
    before = np.where(pos > np.repeat(words.start, length), buf[pos - 1], 32).astype(np.uint64)
    nxt = np.minimum(pos + 1, len(buf) - 1)
    after = np.where(pos + 1 < np.repeat(words.end, length), buf[nxt], 32).astype(np.uint64)
    gram = before << np.uint64(16) | here << np.uint64(8) | after
    slot = (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64) % SLOTS
    return words, slot, first, np.maximum.reduceat(script[pos], first).astype(np.int64)


class Model:
    """langs; table: log probability of each slot by language; scripts: whether a language was seen in a script group."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=1, keepdims=True)
        self.table = np.log((counts + SMOOTH) / (total + SMOOTH * SLOTS)).T.astype(np.float32).copy()
        self.allowed = scripts >= 0.01 * scripts.sum(axis=1, keepdims=True)
        self.allowed[:, ~self.allowed.any(axis=0)] = True

    def word_scores(self, text: pa.StringArray) -> tuple[Words, np.ndarray]:
        words, slot, first, script = features(text)
        if not len(first):
            return words, np.empty((0, len(self.langs)), np.float32)
        score = np.add.reduceat(self.table[slot], first, axis=0)
        score -= score.max(axis=1, keepdims=True)
        score[~self.allowed.T[script]] = -1e4
        return words, np.maximum(score, -1e4)


def viterbi(score: np.ndarray, count: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; count: words of each text. All texts of a slice advance one word at a time."""
    n, k = score.shape
    label = np.zeros(n, dtype=np.int64)
    if not n or k == 1:
        return label
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    order = np.argsort(-count, kind="stable")
    ends, starts = count[order], first[order]
    stay = np.empty((n, k), dtype=bool)
    best = np.empty(n, dtype=np.int16)
    live = int((ends > 0).sum())
    v = score[starts[:live]].astype(np.float64)
    finals = np.zeros((len(count), k))
    t = 1
    few = 8
    while live > few:
        going = int(np.searchsorted(-ends, -t, side="left"))
        finals[going:live] = v[going:live]
        live, v = going, v[:going]
        if live <= few:
            break
        at = starts[:live] + t
        top = v.argmax(axis=1)
        moved = v[np.arange(live), top] - switch
        keep = v >= moved[:, None]
        stay[at], best[at] = keep, top
        v = np.where(keep, v, moved[:, None]) + score[at]
        t += 1
    for i in range(live):  # the few longest texts, one by one
        row, cells = v[i].tolist(), score[starts[i] + t : starts[i] + ends[i]].tolist()
        a = starts[i] + t
        held, tops = [], []
        for cell in cells:
            peak = max(row)
            top = row.index(peak)
            moved = peak - switch
            held.append([x >= moved for x in row])
            tops.append(top)
            row = [(x if x >= moved else moved) + s for x, s in zip(row, cell, strict=True)]
        if cells:
            stay[a : a + len(cells)], best[a : a + len(cells)] = held, tops
        finals[i] = row
    here = finals.argmax(axis=1)
    tail = int((ends > 0).sum())
    short = int(ends[min(few, len(ends) - 1)])
    for i in range(min(few, tail)):  # back through the longest ones
        lab = int(here[i])
        for p in range(starts[i] + ends[i] - 1, starts[i] + min(short, ends[i]) - 1, -1):
            label[p] = lab
            if p > starts[i] and not stay[p, lab]:
                lab = int(best[p])
        here[i] = lab
    for t in range(short - 1, -1, -1):
        live = int(np.searchsorted(-ends, -t, side="left"))
        at = starts[:live] + t
        label[at] = here[:live]
        if t:
            here[:live] = np.where(stay[at, here[:live]], here[:live], best[at])
    return label


def _counts(langs: list[str]):
    number = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, scripts = np.zeros((len(langs), SLOTS), np.int64), np.zeros((len(langs), SCRIPTS), np.int64)
        for whole in batches:
            for batch in slices(whole):
                words, slot, first, script = features(batch.column("text"))
                lang = np.array([number[x] for x in batch.column("lang").to_pylist()])[words.doc]
                for i in np.unique(lang):
                    scripts[i] += np.bincount(script[lang == i], minlength=SCRIPTS)
                    of = np.repeat(lang == i, words.end - words.start)
                    grams[i] += np.bincount(slot[of], minlength=SLOTS)
        yield pa.record_batch([pa.array(langs), pa.array(list(grams), pa.list_(pa.int64())), pa.array(list(scripts), pa.list_(pa.int64()))], ["lang", "grams", "scripts"])

    return count


def _add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    sums = [np.sum([np.array(x) for x in table.column(c).to_pylist()], axis=0) for c in ("grams", "scripts")]
    return pa.table({"lang": [key[0].as_py()], "grams": pa.array([sums[0]], pa.list_(pa.int64())), "scripts": pa.array([sums[1]], pa.list_(pa.int64()))})


def fit(docs: DataFrame, sample: int = SAMPLE, folds: int = 5) -> Model | None:
    """From at most `sample` training rows of each language, those with the smallest hashes; None without any.

    Every language is learned: the model has a row a distinct value of lang.
    """
    known = docs.select("doc_id", "text", "lang").filter(is_training(folds)).filter("lang is not null and text is not null")
    sizes = known.groupBy("lang").count().collect()  # a row a language
    if not sizes:
        return None
    langs = sorted(r.lang for r in sizes)
    # the share of hash space that holds about the rows wanted, and half as many again, is cut to them afterwards
    share = {r.lang: min(1.0, 1.5 * sample / r["count"]) for r in sizes}
    limit = F.create_map(*(x for lang, p in share.items() for x in (F.lit(lang), F.lit(p))))[F.col("lang")]
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    some = known.withColumn("place", place).filter(F.col("place") < limit)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    chosen = some.withColumn("rank", rank).filter(F.col("rank") <= sample).select("text", "lang")
    kind = "lang string, grams array<bigint>, scripts array<bigint>"
    rows = {r.lang: r for r in chosen.mapInArrow(_counts(langs), kind).groupBy("lang").applyInArrow(_add, kind).collect()}  # one row a language
    langs = sorted(rows)
    return Model(langs, np.array([rows[x].grams for x in langs]), np.array([rows[x].scripts for x in langs], dtype=float)) if langs else None


def spans(model: Model, text: str, switch: float = SWITCH) -> list[tuple[int, int, str]]:
    """Byte bounds and language of each stretch of a text."""
    words, score = model.word_scores(pa.array([text]))
    label, out = viterbi(score, words.count, switch), []
    for a, b, k in zip(words.start.tolist(), words.end.tolist(), label.tolist(), strict=True):
        if out and out[-1][2] == model.langs[k]:
            out[-1] = (out[-1][0], b, model.langs[k])
        else:
            out.append((a, b, model.langs[k]))
    return out


def _predict(model: Model | None, switch: float):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 4 << 20):
                rows, text = batch.num_rows, batch.column("text")
                lang, share, parts = ["und"] * rows, np.zeros(rows), np.zeros(rows, np.int64)
                if model is not None:
                    words, score = model.word_scores(text)
                    label = viterbi(score, words.count, switch)
                    k = len(model.langs)
                    letters = np.bincount(words.doc * k + label, weights=words.end - words.start, minlength=rows * k).reshape(rows, k)
                    top, total = letters.argmax(axis=1), letters.sum(axis=1)
                    share = np.where(total > 0, letters.max(axis=1) / np.maximum(total, 1), 0.0)
                    turn = np.ones(len(label), dtype=bool)
                    turn[1:] = (label[1:] != label[:-1]) | (words.doc[1:] != words.doc[:-1])
                    parts = np.bincount(words.doc[turn], minlength=rows)
                    for i, t in enumerate(text):
                        if _LETTER.search(t.as_py()):
                            lang[i] = model.langs[top[i]]
                        else:
                            share[i] = 0.0
                yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(lang), pa.array(share), pa.array(parts, pa.int64())], ["doc_id", "held_out", "lang_pred", "score", "n_spans"])

    return predict


def languages(docs: DataFrame, sample: int = SAMPLE, switch: float = SWITCH, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score (share of letters in that language), n_spans for each row.

    `und` for null texts and those without a letter, and for all if no language can be learned. No shuffle of texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (~is_training(folds)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(fit(docs, sample, folds), switch), f"doc_id {kind}, held_out boolean, lang_pred string, score double, n_spans long")
