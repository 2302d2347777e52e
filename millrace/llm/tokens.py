"""Token ids of whole texts by the ``tokenizers`` library, as little-endian bytes."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.common import worker_memo

#: Words a worker remembers; a full memory is emptied, which costs time and changes nothing.
CACHE_ENTRIES = 1_000_000
#: New words that are encoded as one string.
JOINED = 1000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Byte-level BPE with a memory for words.

    The pre-tokenizer of byte-level BPE always begins a token at a single blank between two characters
    that are not white space.  So texts are cut there, and each different piece is encoded once.  Texts
    with other runs of blanks or rarer white space are cut at the safe blanks by a pattern.

    New pieces with a blank in front are encoded joined to long strings, which are safe to cut for the same
    reason; their ids come apart where a token begins with a blank.

    Names of special tokens in a text give their ids, as the library does by itself; with ``plain_names`` they
    are ordinary text.
    """

    RARE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    SAFE = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str, plain_names: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_names
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        # Fixed value: how byte-level vocabularies write a blank.
        self.blank[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.known: dict[str, bytes] = {}

    def many(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text, four bytes an id; null counts as empty."""
        texts = [t or "" for t in texts]
        odd = ["  " in t or " \n" in t or "\n " in t or t[-1:] == " " or self.RARE.search(t) is not None for t in texts]
        lists = pc.split_pattern(pa.array([t for t, o in zip(texts, odd) if not o], pa.large_string()), " ")
        words = lists.flatten().dictionary_encode()
        behind = [" " + w for w in words.dictionary.to_numpy(zero_copy_only=False)]  # a word that is not the first has its blank
        places, ends = words.indices.to_numpy().tolist(), lists.offsets.to_numpy().tolist()
        cut = [self.SAFE.split(t) if o else None for t, o in zip(texts, odd)]
        first = [t.partition(" ")[0] for t, o in zip(texts, odd) if not o]
        held = self._ids({*first, *(p for c in cut if c for p in c)}, behind)
        table, plain = [held[p] for p in behind], iter(zip(first, ends, ends[1:]))
        out = []
        for c in cut:
            if c is not None:
                out.append(b"".join([held[p] for p in c]))
                continue
            head, begin, end = next(plain)
            out.append(held[head] + b"".join([table[k] for k in places[begin + 1 : end]]))
        return out

    def _ids(self, pieces: set[str], behind: list[str]) -> dict[str, bytes]:
        """The ids of all pieces, and of those that have one blank, in front, and follow other text."""
        known = self.known
        new = [p for p in pieces if p not in known]
        joined = [p for p in behind if p not in known and len(p) > 1 and p not in pieces]
        found: dict[str, bytes] = {}
        groups = [joined[at : at + JOINED] for at in range(0, len(joined), JOINED)]
        for some in self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False) if groups else ():
            self._apart(groups.pop(0), some.ids, found)
        new += [p for p in behind if p not in known and p not in found and p not in pieces]
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            results = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            found.update((p, array("I", e.ids).tobytes()) for p, e in zip(some, results))
        if len(known) + len(found) > CACHE_ENTRIES:
            found.update((p, known[p]) for p in (*pieces, *behind) if p in known)
            self.known = found
            return found
        known.update(found)
        return known

    def _apart(self, pieces: list[str], ids: list[int], found: dict[str, bytes]) -> None:
        """The ids of each of the pieces that were encoded as one; if they do not come apart, each is encoded alone."""
        ids = np.array(ids, "<u4")
        begin = np.flatnonzero(self.blank[ids])
        if len(begin) == len(pieces) and begin[0] == 0:
            raw, edges = ids.tobytes(), [*(4 * begin).tolist(), 4 * len(ids)]
            found.update((p, raw[a:b]) for p, a, b in zip(pieces, edges, edges[1:]))


def encoder(path: str, plain_names: bool = False) -> Encoder:
    """The encoder of this Python worker."""
    return worker_memo(("encoder", path, plain_names), lambda: Encoder(path, plain_names))
