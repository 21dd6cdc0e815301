"""Token ids of whole texts.

A text is cut at ASCII white space, which no token of the vocabulary crosses, and each
distinct piece is encoded once per worker by the ``tokenizers`` library. The ids equal
``Tokenizer.encode(text, add_special_tokens=False)`` followed by the end id.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

END_ID = 1
_WIDE = re.compile("[̀-\U0010ffff]")  # beyond here, lower-casing and NFC may not commute
_ENCODERS: dict[tuple[str, int], "Encoder"] = {}


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The printable stand-in for each byte value in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encodes batches of texts; remembers up to ``cache_words`` pieces."""

    def __init__(self, path: str, end_id: int = END_ID, cache_words: int = 3 << 18):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id, self.cache_words = end_id, cache_words
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        spec = json.load(open(path, encoding="utf-8"))
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        #: lower case, white space dropped: only then may pieces be cut and cached
        self.words = any(s["type"] == "Lowercase" for s in steps)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.letters = _byte_letters()

    def _piece(self, piece: str) -> bytes | None:
        """Ids of a run of letters, by the model alone; None for any other piece."""
        wide = piece
        piece = piece.lower()
        if not piece.isalpha() or not piece.isascii() and (_WIDE.search(wide) or _WIDE.search(piece)):
            return None
        if not piece.isascii():
            piece = "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        rest = []
        for piece in pieces:
            ids = self._piece(piece)
            if ids is None:
                rest.append(piece)
            else:
                self.cache[piece] = ids
        for piece, found in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)):
            self.cache[piece] = array("I", found.ids).tobytes()

    def _whole(self, text: str) -> np.ndarray:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array([*ids, self.end_id], dtype="<u4")

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces. Pieces not met for a whole generation are forgotten."""
        if len(self.cache) > self.cache_words // 2:
            self.older, self.cache = self.cache, {}
        cache, older, missing = self.cache, self.older, []
        for piece in pieces:
            if piece not in cache:
                if piece in older:
                    cache[piece] = older[piece]
                else:
                    missing.append(piece)
        self._learn(missing)
        return [cache[p] for p in pieces]

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        cut = pc.replace_substring_regex(pa.array(texts, pa.large_string()),
                                         r"([a-zà-öø-ÿ])([!-/:-@\[-`{-~])", r"\1 \2")
        lists = pc.ascii_split_whitespace(cut)
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        ids = pa.array(self._known(pieces) + [self.end_id.to_bytes(4, "little")], pa.large_binary())
        ends = lists.offsets.to_numpy()[1:]
        flat = ids.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(pieces))))
        _, places, data = flat.buffers()
        upto = np.frombuffer(places, "<i8")[1 + ends + np.arange(len(ends))] // 4
        return np.split(np.frombuffer(data, "<u4", upto[-1]), upto[:-1])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """One little-endian uint32 array per text, with the end id; null is the empty text."""
        result: list[np.ndarray | None] = [None] * len(texts)
        held, places, size = [], [], 0

        def flush():
            if held:
                for place, ids in zip(places, self._some(held)):
                    result[place] = ids
                held.clear(), places.clear()

        for place, text in enumerate(texts):
            text = text or ""
            if not self.words or any(s in text for s in self.special):
                result[place] = self._whole(text)
                continue
            held.append(text.lower() if text.isascii() or not _WIDE.search(text) else text)
            places.append(place)
            size += len(text)
            if size > 12_000_000:
                flush()
                size = 0
        flush()
        return result


def encoder(path: str, end_id: int = END_ID) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def tokenise(docs: DataFrame, keep: list[str], text: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Columns ``keep`` and ``ids``, the little-endian uint32 ids of each whole text with
    the end id. ``path`` has to exist on the executors. An empty table gives an empty one."""
    chosen = docs.select(*keep, text)
    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes), "ids binary"])

    def run(batches):
        encode = encoder(path, end_id).encode
        for batch in batches:
            ids = pa.array([x.tobytes() for x in encode(batch.column(len(keep)).to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], ids], [*keep, "ids"])

    return chosen.mapInArrow(run, schema)
