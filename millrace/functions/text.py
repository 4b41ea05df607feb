"""Turning text into lexemes, chunks and hashed-feature vectors."""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Short stop-word lists per language code.
STOP_WORDS = {
    "en": ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "had", "has",
           "have", "he", "her", "his", "i", "if", "in", "into", "is", "it", "its", "me", "my",
           "no", "not", "of", "on", "or", "our", "she", "so", "that", "the", "their", "them",
           "then", "there", "these", "they", "this", "to", "was", "we", "were", "which", "will",
           "with", "you", "your"],
    "fr": ["au", "aux", "avec", "ce", "ces", "dans", "de", "des", "du", "elle", "en", "et", "il",
           "je", "la", "le", "les", "leur", "mais", "ne", "nous", "on", "ou", "par", "pas",
           "pour", "qu", "que", "qui", "sa", "se", "ses", "son", "sur", "un", "une", "vous"],
    "de": ["aber", "als", "am", "an", "auch", "auf", "aus", "bei", "das", "dem", "den", "der",
           "des", "die", "ein", "eine", "er", "es", "für", "ich", "im", "in", "ist", "mit",
           "nicht", "oder", "sich", "sie", "sind", "um", "und", "von", "war", "wie", "wir", "zu"],
    "es": ["a", "al", "como", "con", "de", "del", "el", "en", "es", "ha", "la", "las", "lo",
           "los", "más", "no", "o", "para", "pero", "por", "que", "se", "su", "sus", "un", "una",
           "y"],
}
#: Fixed value: English endings that the light suffix rule removes.
ENDINGS = ["ing", "ed", "es", "s"]
#: Fixed value: shortest stem the suffix rule may leave.
SHORTEST_STEM = 3

_GAP = r"[^\p{L}\p{N}]+"


def joined_text(*columns: str | Column) -> Column:
    """Columns joined by one space, NULL counting as empty."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cols])


def _light_stem(word: Column) -> Column:
    """Drop one English ending, the longest that leaves a long enough stem."""
    size = F.length(word)
    out = F.when(F.lit(False), word)
    for length in sorted({len(e) for e in ENDINGS}, reverse=True):
        ends = [F.endswith(word, F.lit(e)) for e in ENDINGS if len(e) == length]
        out = out.when((size >= SHORTEST_STEM + length) & reduce(or_, ends), F.left(word, size - length))
    return out.otherwise(word)


def lexemes(text: str | Column, lang: str | Column = "en") -> Column:
    """Stop-word-free lexemes in reading order, repeats kept.

    ``lang`` is a language code, or a column holding one; codes without a list keep all words.
    English words lose one light suffix. One split per text, then plain string tests per word:
    several times cheaper than further regular expressions.
    """
    col = F.col(text) if isinstance(text, str) else text
    words = F.split(F.lower(F.coalesce(col, F.lit(""))), _GAP)

    def kept(code: str | None) -> Column:
        out = F.filter(words, lambda w: (w != "") & ~w.isin(STOP_WORDS.get(code, [])))
        return F.transform(out, _light_stem) if code == "en" else out

    if isinstance(lang, str):
        return kept(lang)
    out = F.when(lang == "en", kept("en"))
    for code in STOP_WORDS:
        if code != "en":
            out = out.when(lang == code, kept(code))
    return out.otherwise(kept(None))


# The characters Python counts as blank, and those it ends a line at.
_BLANK = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
          "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_LINE_END = "\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"


def strip(col: Column) -> Column:
    """Remove blank characters from both ends."""
    return F.btrim(col, F.lit(_BLANK))


def chunks(body: str | Column, max_chars: int = 1800, overlap: int = 200,
           drop_contained: bool = False) -> Column:
    """Split a text at ``## `` headings, then long sections into overlapping windows.

    Returns ``array<string>``. Blank chunks are left out. By default the last window may lie
    inside the one before it, as the plain stepping rule gives; ``drop_contained`` removes it.
    """
    if not 0 <= overlap < max_chars:
        raise ValueError("overlap must be at least 0 and below max_chars")
    col = F.col(body) if isinstance(body, str) else body
    text = F.translate(F.replace(strip(F.coalesce(col, F.lit(""))), F.lit("\r\n"), F.lit("\n")),
                       _LINE_END, "\n" * len(_LINE_END))
    sections = F.transform(F.split(text, r"\n(?=## )"), strip)
    step = max_chars - overlap

    def windows(section: Column) -> Column:
        size = F.length(section)
        last = F.greatest(size - F.lit(overlap) - 1, F.lit(0)) if drop_contained else size - 1
        starts = F.sequence(F.lit(0), last, F.lit(step))
        cut = F.transform(starts, lambda i: F.substring(section, i + 1, F.lit(max_chars)))
        return F.when(size <= max_chars, F.array(section)).otherwise(cut)

    return F.filter(F.flatten(F.transform(sections, windows)),
                    lambda c: F.length(strip(c)) > 0)


def word_chunks(body: str | Column, max_words: int = 500, overlap: int = 50) -> Column:
    """Overlapping windows of blank-separated words, joined by single spaces."""
    if not 0 <= overlap < max_words:
        raise ValueError("overlap must be at least 0 and below max_words")
    col = F.col(body) if isinstance(body, str) else body
    words = F.filter(F.split(F.coalesce(col, F.lit("")), r"\s+"), lambda w: w != "")
    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(max_words - overlap))
    return F.filter(F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(max_words)), " ")),
                    lambda c: c != "")


def parse_importance(output: str | Column) -> tuple[Column, Column]:
    """Summary and importance out of model text.

    A line starting with IMPORTANCE (any case) carries the number after its first colon,
    clamped to [0, 1]; the last readable one counts, 0.5 if there is none. The other lines,
    stripped and joined by spaces, are the summary.
    """
    col = F.col(output) if isinstance(output, str) else output
    lines = F.split(strip(F.coalesce(col, F.lit(""))), "\n")
    marked = F.filter(lines, lambda x: F.startswith(F.upper(x), F.lit("IMPORTANCE")))
    numbers = F.filter(
        F.transform(marked, lambda x: strip(F.regexp_extract(x, r"^[^:]*:(.*)$", 1))
                    .try_cast("double")),
        lambda v: v.isNotNull() & ~F.isnan(v))
    found = F.try_element_at(numbers, F.lit(-1))
    importance = (F.when(found.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), found)))
                  .otherwise(F.lit(0.5)))
    kept = F.filter(lines, lambda x: ~F.startswith(F.upper(x), F.lit("IMPORTANCE")))
    summary = F.array_join(F.filter(F.transform(kept, strip), lambda x: x != ""), " ")
    return summary, importance


def strings(column: pa.Array) -> list[str | None]:
    """The column as Python strings, by one pass over its buffers instead of an Arrow scalar for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def features_of(tokens: list[str], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and signs of tokens: hex digits 1-8 of the MD5 pick the bucket, digit 9 the sign."""
    md5 = hashlib.md5
    digests = np.frombuffer(b"".join([md5(t.encode("utf-8")).digest() for t in tokens]), np.uint8).reshape(-1, 16)
    bucket = np.ascontiguousarray(digests[:, :4]).view(">u4").ravel().astype(np.int64) % dims
    return bucket, np.where(digests[:, 4] & 16, -1.0, 1.0).astype(np.float32)


def word_lists(column: pa.Array) -> pa.Array:
    """Lists of words, given as such or joined by one space; an empty string holds none."""
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        return column
    return pc.split_pattern(pc.if_else(pc.equal(column, ""), None, column), " ")


def hashed_features(tokens: pa.Array, dims: int) -> np.ndarray:
    """Signed token counts per bucket, one row per token list (or per string of tokens, see :func:`word_lists`).

    Each distinct token of the batch is looked up once; the rest is array arithmetic.
    """
    tokens = word_lists(tokens)
    lengths = np.nan_to_num(tokens.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    out = np.zeros((len(lengths), dims), dtype=np.float32)
    encoded = tokens.flatten().dictionary_encode()
    if not len(encoded):
        return out
    bucket, sign = features_of(strings(encoded.dictionary), dims)
    index = encoded.indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    np.add.at(out, (owner, bucket[index]), sign[index])
    return out
