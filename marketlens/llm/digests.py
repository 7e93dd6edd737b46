"""What the corpus queries report of an operator's outputs, made where the outputs are."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

PIECES = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def pieces(docs, valid, sizes, sequence, ids, texts, end):
    """Number and hash of all ids, and hash of the decoded text, per document of a block."""
    counts = np.array([len(own) for own in ids], np.int64)
    names = [" ".join(map(str, own)) for own in ids]
    ends = np.cumsum(sizes.astype(np.int64))
    n_tokens, ids_hash, text_hash = [], [], []
    for stop, size in zip(ends.tolist(), sizes.tolist()):
        own = sequence[stop - size : stop]
        n_tokens.append(int(counts[own].sum()) + 1 if size else 1)
        own = own.tolist()
        ids_hash.append(hashlib.sha256(" ".join([*[names[c] for c in own], str(end)]).encode()).hexdigest())
        text_hash.append(hashlib.sha256(" ".join([texts[c] for c in own]).encode()).hexdigest())
    yield pa.RecordBatch.from_pydict({
        "doc_id": pa.array(docs, pa.int64(), mask=~valid), "n_tokens": pa.array(n_tokens, pa.int64()),
        "ids_sha256": ids_hash, "decoded_sha256": text_hash,
    })


def sha256(text: str) -> str:
    """Lowercase hex of the text's hash; nothing for no text."""
    return hashlib.sha256(text.encode()).hexdigest() if text else ""
