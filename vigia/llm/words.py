"""Words of many texts at once, as numbers."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Words(NamedTuple):
    """``number`` of each word of all texts, one text after the other; ``starts`` of the texts (one more than there are
    texts); ``known``: the different words, which the numbers are places in."""

    number: np.ndarray
    starts: np.ndarray
    known: pa.Array


def split_words(texts: pa.Array) -> Words:
    """Words are what stands between ASCII white space (space, tab, line feed, vertical tab, form feed, carriage return).

    A NULL text has none.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    offsets, flat = lists.offsets.to_numpy(), lists.flatten()
    held = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(held)])
    coded = flat.filter(pa.array(held)).dictionary_encode()
    return Words(coded.indices.to_numpy(), before[offsets - offsets[0]], coded.dictionary)
