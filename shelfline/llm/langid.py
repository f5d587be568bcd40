"""Language ID: script ranges narrow the candidates, then Viterbi over per-word scores labels spans.

The model is fitted on a bounded sample of labelled documents (about ``PER_LANG`` whole texts of
every language, drawn by hash), whose trigrams are counted where they are read: smoothed
log-probabilities of byte trigrams, word edges included, and the scripts a language uses.
Every document is then labelled whole, inside its scan: no shuffle.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import textops

PER_LANG = 400
BITS = 15  # trigram table size
PENALTY = 6.0  # log-probability a change of language costs
LEAST_SHARE = 0.01  # of a language's letters, for a script to count as its own
WORST = -4.0  # log-odds of a word in a script the language does not use
UNKNOWN = "und"

# UTF-8 lead bytes by script. 0 none, 1 Latin, 2 Greek, 3 Cyrillic, 4 Armenian/Hebrew,
# 5 Arabic and neighbours, 6 Indic and South-East Asian, 7 kana and symbols, 8 Han, 9 Hangul.
_SCRIPT = np.zeros(256, np.uint8)
_SCRIPT[ord("A"):ord("Z") + 1] = _SCRIPT[ord("a"):ord("z") + 1] = 1
_SCRIPT[0xC3:0xCC] = 1
_SCRIPT[0xCE:0xD0] = 2
_SCRIPT[0xD0:0xD4] = 3
_SCRIPT[0xD4:0xD8] = 4
_SCRIPT[0xD8:0xE0] = 5
_SCRIPT[0xE0:0xE1] = 6
_SCRIPT[0xE1:0xE2] = 6
_SCRIPT[0xE3:0xE4] = 7
_SCRIPT[0xE4:0xEA] = 8
_SCRIPT[0xEA:0xEE] = 9
SCRIPTS = 10


def held_out(doc_id="doc_id"):
    """Documents kept from learning: crc32 of the id as text, modulo 4, is 2 (a null id has no crc32 and is held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (2 ** BITS, languages): log-probability of a trigram, less the mean over languages
    allowed: np.ndarray  # (SCRIPTS, languages)


def _trigrams(run: textops.Words) -> tuple[np.ndarray, np.ndarray]:
    """(trigram id of each byte, taken with its neighbours; script of each byte). Word edges read as a space."""
    inside = np.zeros(len(run.data) + 2, np.uint32)
    low = run.data.astype(np.uint32)
    capital = (low >= 65) & (low <= 90)
    low[capital] += 32
    low[textops._SPACE[run.data]] = 32
    inside[1:-1], inside[0], inside[-1] = low, 32, 32
    left, right = inside[:-2].copy(), inside[2:].copy()
    left[run.start], right[run.end - 1] = 32, 32  # words of neighbouring documents may touch
    packed = (left * np.uint32(65536) + low * np.uint32(256) + right) * np.uint32(2654435761)
    return packed >> np.uint32(32 - BITS), _SCRIPT[run.data]


def fit(langs: list[str], counts: np.ndarray, scripts: np.ndarray) -> Model:
    """A model from each language's trigrams (2 ** BITS, languages) and letters by script (SCRIPTS, languages)."""
    if not langs:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.ones((SCRIPTS, 0), bool))
    logs = np.log((counts + 0.1) / (counts.sum(0) + 0.1 * (1 << BITS)))
    logs = np.clip(logs - logs.mean(1, keepdims=True), -6, 6)
    scripts[0] = 0
    allowed = scripts >= LEAST_SHARE * np.maximum(scripts.sum(0), 1)
    allowed[0] = True
    allowed[~allowed.any(1)] = True  # a script nobody uses decides nothing
    return Model(langs, logs.astype(np.float32), allowed)


def _counted(batches):
    """(lang, id, n): trigrams of each language's texts in a batch; ids from 2 ** BITS on are scripts."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        own, places = langs.indices.to_numpy(zero_copy_only=False), len(langs.dictionary)
        counts = np.zeros((places, (1 << BITS) + SCRIPTS), np.int64)
        for run in textops.words(batch.column("text")):
            ids, script = _trigrams(run)
            doc = np.repeat(np.arange(len(run.start)), run.end - run.start)
            lang = own[run.first + run.doc_of_word()[doc]]
            inside = ~textops._SPACE[run.data]
            np.add.at(counts, (lang, ids[inside]), 1)
            np.add.at(counts, (lang, (1 << BITS) + script[inside].astype(np.int64)), 1)
        lang, ids = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(lang)), pa.array(ids.astype(np.int32)), pa.array(counts[lang, ids])], ["lang", "id", "n"])


def learn(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Fit on about ``per_lang`` learning documents of every language.

    A language's documents are drawn by the hash of id and text at the rate that gives that number (all
    of them where there are fewer, one hash at least). The driver sees one row a language and its trigram
    counts, at most 32,768 a language; no text. Null texts and labels teach nothing; without any label, or in an
    empty table, the model has no language. Repeated rows are drawn together; empty and very long texts count as they are.
    """
    labelled = docs.filter(~held_out()).filter("text is not null and lang is not null")
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    found = labelled.select("lang", place.alias("place")).groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least")).collect()
    if not found:
        return fit([], np.zeros((1 << BITS, 0)), np.zeros((SCRIPTS, 0)))
    rates = F.create_map(*[F.lit(x) for row in found for x in (row["lang"], max(row["least"], per_lang / row["n"]))])
    sample = labelled.filter(place <= rates[F.col("lang")]).select("lang", "text")
    counted = sample.mapInArrow(_counted, "lang string, id int, n long").groupBy("lang", "id").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(row["lang"] for row in found)
    number = {lang: k for k, lang in enumerate(langs)}
    counts = np.zeros(((1 << BITS) + SCRIPTS, len(langs)))
    names = counted.column("lang").combine_chunks().dictionary_encode()
    at = np.array([number[x] for x in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy(zero_copy_only=False)] if counted.num_rows else np.zeros(0, np.int64)
    counts[counted.column("id").to_numpy(), at] = counted.column("n").to_numpy()
    return fit(langs, counts[:1 << BITS], counts[1 << BITS:])


def _slice(model: Model) -> int:
    """Bytes of text judged together: fewer where a word has very many languages' scores."""
    return max(1 << 12, textops.SLICE_BYTES * 64 // max(64, len(model.langs)))


def _word_scores(model: Model, run: textops.Words) -> np.ndarray:
    """(words, languages): mean-free log-probability of each word, squashed by its length; unfit scripts pay."""
    ids, script = _trigrams(run)
    out = np.empty((len(run.start), len(model.langs)), np.float32)
    spans = np.empty(2 * len(run.start), np.int64)
    spans[0::2], spans[1::2] = run.start, run.end
    if spans[-1] == len(ids):
        spans = spans[:-1]
    for k in range(len(model.langs)):
        out[:, k] = np.add.reduceat(model.table[:, k][ids], spans)[0::2]
    words_script = np.maximum.reduceat(script, spans)[0::2]
    odd = words_script > 1
    out[odd] = np.where(model.allowed[words_script[odd]], out[odd], WORST * np.sqrt((run.end - run.start)[odd])[:, None])
    return out


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word, document by document: a change of label costs ``penalty``.

    All documents of the run step together, longest first, so that the loop runs over
    word positions and each step is one array operation over the documents still going.
    """
    n, langs = scores.shape
    kind = np.uint8 if langs <= 256 else np.int32
    labels = np.zeros(n, kind)
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = bounds[:-1][order], lengths[order]
    if not n or not lengths[0]:
        return labels
    going = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # documents longer than t
    stay = np.ones((n, langs), bool)  # keeping the label was best
    came = np.zeros(n, kind)  # else the label came from here
    best = scores[starts[:going[0]]].copy()
    last = np.zeros(len(order), kind)
    for t in range(1, int(lengths[0])):
        g = going[t]
        if g < len(best):
            last[g:len(best)] = best[g:].argmax(1)
            best = best[:g]
        at = starts[:g] + t
        source = best.argmax(1)
        jump = best[np.arange(g), source][:, None] - penalty
        keep = best >= jump
        stay[at], came[at] = keep, source
        best = np.where(keep, best, jump) + scores[at]
    last[:len(best)] = best.argmax(1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        g = going[t]
        at = starts[:g] + t
        labels[at] = last[:g]
        last[:g] = np.where(stay[at, last[:g]], last[:g], came[at])
    return labels


def _has_letter(run: textops.Words, texts: pa.Array) -> np.ndarray:
    ascii_letter = _SCRIPT[run.data] == 1
    ascii_letter &= run.data < 128
    sums = np.concatenate([[0], np.cumsum(ascii_letter)])
    found = np.zeros(len(run), bool)
    for i in range(len(run)):
        lo, hi = run.bounds[i], run.bounds[i + 1]
        if lo < hi:
            found[i] = sums[run.end[hi - 1]] > sums[run.start[lo]] or any(c.isalpha() for c in texts[run.first + i].as_py() or "")
    return found


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY, spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score, n_words and (``spans``) the labelled spans of every document.

    The words' best path gives the spans; lang_pred is the label that holds most of the
    text's bytes, score its part of them. Null, empty and letterless texts, and every text
    when no language was learned, are ``und`` with score 0 and no spans. Labels, sources
    and ids are never read for a prediction; equal texts get equal answers; ties go to the
    language that sorts first.
    """
    names = model.langs

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            pred, score, many, pieces = [], [], [], []
            for part in textops.words(texts, _slice(model)):
                letters = _has_letter(part, texts)
                sizes = part.end - part.start
                if names and len(part.start):
                    labels = viterbi(_word_scores(model, part), part.bounds, penalty)
                else:
                    labels = np.zeros(len(part.start), np.uint8)
                flat = part.doc_of_word() * max(1, len(names)) + labels
                share = np.bincount(flat, weights=sizes, minlength=len(part) * max(1, len(names))).reshape(len(part), -1)
                top = share.argmax(1)
                for i in range(len(part)):
                    known = bool(names) and bool(letters[i])
                    pred.append(names[top[i]] if known else UNKNOWN)
                    score.append(float(share[i, top[i]] / share[i].sum()) if known else 0.0)
                    many.append(int(part.bounds[i + 1] - part.bounds[i]))
                    if spans:
                        own = labels[part.bounds[i]:part.bounds[i + 1]]
                        cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1]) if known else np.zeros(0, np.int64)
                        ends = np.append(cuts[1:], len(own)) if known else cuts
                        pieces.append([{"lang": names[own[a]], "first_word": int(a), "n_words": int(b - a)} for a, b in zip(cuts, ends, strict=True)])
            columns = {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64()), "n_words": pa.array(many, pa.int64())}
            if spans:
                columns["spans"] = pa.array(pieces, pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, lang_pred string, score double, n_words long" + (", spans array<struct<lang:string,first_word:long,n_words:long>>" if spans else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """``docs`` without those whose language is unknown, or whose main language holds less than ``least`` of the text.

    A model without languages tells nothing: all rows pass.

    Rows pass whole, in their scan: a row is judged on its text alone, so ids that are
    null or repeated make no difference. Null, empty and letterless texts go.
    """
    if not model.langs:
        return docs

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            keep = np.zeros(batch.num_rows, bool)
            for part in textops.words(texts, _slice(model)):
                if not len(part.start):
                    continue
                labels = viterbi(_word_scores(model, part), part.bounds, PENALTY)
                flat = part.doc_of_word() * len(model.langs) + labels
                share = np.bincount(flat, weights=part.end - part.start, minlength=len(part) * len(model.langs)).reshape(len(part), -1)
                good = share.max(1) >= least * np.maximum(share.sum(1), 1)
                keep[part.first:part.first + len(part)] = good & _has_letter(part, texts)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def crc_of(doc_id: int) -> int:
    """The held-out rule outside Spark, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 4
