"""Byte-pair encoding of whole texts, and decoding, from a published tokenizer file."""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from chronoloom.llm import arrowtext
from chronoloom.llm.tasks import tidy

REMEMBERED_BYTES = 32 << 20
"""Encoded words that a Python process keeps at hand, in two generations of about this size at most. Others are encoded again."""

ENTRY_BYTES = 400
"""What a short word costs; longer ones add their own length."""

WHITE = r"\t-\r \x85\xa0  -     　"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class _Encoded(dict):
    """Words to (ids as bytes, decoded text), filled on demand; the older half goes when both generations are full."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode, self.older, self.size = encode, {}, 0

    def __missing__(self, word: str) -> tuple[bytes, str]:
        found = self.older.get(word) or self.encode(word)
        if self.size >= REMEMBERED_BYTES:
            self.older, self.size = dict(self), 0
            self.clear()
        self[word] = found
        self.size += ENTRY_BYTES + 4 * len(word) + len(found[0]) + 4 * len(found[1])
        return found


class WordBpe:
    """A tokenizer of lower-cased words with word ends, such as ``word_bpe_49k.json``.

    Text is put into NFC and lower case character by character, cut into words by the file's own pattern, and each word's bytes are
    merged by rank. Special tokens in a text are kept whole. There is no decoder, so decoded text is the vocabulary strings with spaces between.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The file's pattern means Unicode white space by \s, without the separators U+001C to U+001F.
        self.pattern = pattern.replace(r"\s", WHITE)
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.strings = {number: text for text, number in (vocab | self.special).items()}
        end = model["end_of_word_suffix"]
        self.inner = [vocab.get(c) for c in byte_characters()]
        self.last = [vocab.get(c + end) for c in byte_characters()]
        self.merges = {}
        for rank, (left, right) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges[vocab[left] << 32 | vocab[right]] = (rank, vocab[left + right])
        self._ready()

    def _ready(self) -> None:
        self.words = regex.compile(self.pattern).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        self.known = _Encoded(self._word)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("words", "cut", "known")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours of a symbol list, lowest rank first, leftmost first among equals.

        Symbols form a doubly linked list and possible merges a priority queue. A merge whose symbols have changed since it was queued
        is stale and skipped.
        """
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        after[-1] = -1
        queue = []
        for at in range(n - 1):
            if merge := self.merges.get(symbols[at] << 32 | symbols[at + 1]):
                queue.append((merge[0], at, symbols[at], symbols[at + 1], merge[1]))
        heapq.heapify(queue)
        while queue:
            _, at, left, right, joined = heapq.heappop(queue)
            there = after[at]
            if symbols[at] != left or there < 0 or symbols[there] != right:
                continue
            symbols[at], symbols[there] = joined, -1
            after[at] = following = after[there]
            if following >= 0:
                before[following] = at
                if merge := self.merges.get(joined << 32 | symbols[following]):
                    heapq.heappush(queue, (merge[0], at, joined, symbols[following], merge[1]))
            if (previous := before[at]) >= 0 and (merge := self.merges.get(symbols[previous] << 32 | joined)):
                heapq.heappush(queue, (merge[0], previous, symbols[previous], joined, merge[1]))
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> tuple[bytes, str]:
        data = word.encode("utf-8", "surrogatepass")
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        ids = self.merge([s for s in symbols if s is not None])
        return np.array(ids, dtype="<u4").tobytes(), self.decode(ids)

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        lower = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        return [self.known[w] for w in self.words(lower)]

    def encoded(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit numbers, and the decoded text."""
        if self.cut and "<" in text:
            parts = []
            for part in self.cut(text):
                if part in self.special:
                    parts.append((np.array([self.special[part]], dtype="<u4").tobytes(), part))
                elif part:
                    parts += self._plain(part)
        else:
            parts = self._plain(text)
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[0]])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text)[0], dtype="<u4").tolist()

    def decode(self, ids: Sequence[int]) -> str:
        return " ".join([self.strings[i] for i in ids if i in self.strings])


def _rows(tokenizer, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer.value.encoded
        for batch in arrowtext.slices(batches, "text"):
            sizes, ids, decoded = [], [], []
            for text in pc.fill_null(batch.column("text").cast(pa.large_string()), "").to_pylist():
                packed, back = encode(text)
                sizes.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest() if digests else np.frombuffer(packed, dtype="<u4").astype(np.int32))
                decoded.append(hashlib.sha256(back.encode()).hexdigest() if digests else back)
            kinds = (pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.string())
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, kinds[0]), pa.array(decoded, kinds[1])], names=names)

    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Token ids of every row of ``docs(doc_id, text)`` and the text decoded from them: doc_id, n_tokens, ids, decoded.

    ``path`` names a tokenizer file on the driver; its tables are sent to executors. Null and empty texts have no tokens and decode to
    the empty text; long texts are encoded whole; repeated rows each get their row. Other columns are ignored.
    """
    tokenizer = docs.sparkSession.sparkContext.broadcast(WordBpe(path))  # as large as the file, whatever the input
    return docs.select("doc_id", "text").mapInArrow(tidy(_rows(tokenizer, False)), "doc_id long, n_tokens long, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``encode_documents``, with SHA-256 of the packed ids and of the decoded text in place of both: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(WordBpe(path))
    return docs.select("doc_id", "text").mapInArrow(tidy(_rows(tokenizer, True)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
