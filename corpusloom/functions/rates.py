"""Edit distances and speaking rate."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cer(reference: Column, hypothesis: Column) -> Column:
    """Character edits over reference characters; may exceed 1; null for an empty reference or hypothesis."""
    return F.when((reference != "") & (hypothesis != ""), F.levenshtein(reference, hypothesis) / F.length(reference))


#: Pairs whose words are numbered at a time; less than an Arrow batch, so that a worker stays small.
PAIRS = 512


def _numbered(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
    sides = (reference, hypothesis)
    coded = pa.chunked_array([x.flatten() for x in sides]).dictionary_encode("encode")  # one dictionary for both
    words = np.concatenate([c.indices.to_numpy() for c in coded.chunks])
    sizes = np.stack([pc.fill_null(pc.list_value_length(x), 0).to_numpy() for x in sides])
    ends = np.cumsum(sizes).reshape(sizes.shape)  # the references' words lie before the hypotheses'
    out: tuple[list[str], list[str]] = [], []
    for (n, m), (r, h) in zip(sizes.T.tolist(), ends.T.tolist(), strict=True):
        at = np.unique(np.concatenate([words[r - n : r], words[h - m : h]]), return_inverse=True)[1].astype(np.uint32) + np.uint32(1)
        at[at >= 0xD800] += 0x800
        both = at.tobytes().decode("utf-32-le")
        out[0].append(both[:n])
        out[1].append(both[n:])
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()) for texts in out], ["reference", "hypothesis"])


@F.arrow_udf(T.StructType([T.StructField("reference", T.StringType()), T.StructField("hypothesis", T.StringType())]))
def _as_characters(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
    """Each pair of word lists as two strings of one character a word, the same for equal words; surrogates are skipped. Words are numbered by Arrow, none becomes a Python object; long texts cost in proportion but for a sort."""
    return pa.concat_arrays([_numbered(reference.slice(k, PAIRS), hypothesis.slice(k, PAIRS)) for k in range(0, max(len(reference), 1), PAIRS)])


def word_distance(reference: Column, hypothesis: Column) -> Column:
    """Levenshtein distance of two word arrays."""
    both = _as_characters(reference, hypothesis)
    return F.levenshtein(both["reference"], both["hypothesis"])


def wer(reference: Column, hypothesis: Column) -> Column:
    """Word edits over reference words, for texts normalised to single spaces."""
    r, h = F.split(reference, " "), F.split(hypothesis, " ")
    return F.when((reference != "") & (hypothesis != ""), word_distance(r, h) / F.size(r))


def chars_per_second(text: Column, duration: Column) -> Column:
    """Characters but U+0020 over seconds."""
    return F.length(F.replace(text, F.lit(" "), F.lit(""))) / F.greatest(duration, F.lit(1e-6))
