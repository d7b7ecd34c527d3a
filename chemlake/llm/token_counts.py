"""Token counts of whole texts under a byte-level BPE vocabulary (operator 6).

Each pre-token is a linked list of byte symbols; a heap pops the lowest-rank adjacent pair until none is
left, and the pre-token counts as its initial symbols minus the merges made.  No identifiers are produced.
"""

from __future__ import annotations

import functools
import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.llm.workspace import small_batches

#: Pre-tokens kept with their counts in each Python worker; beyond that the cache starts anew.
CACHE_WORDS = 500_000
#: Longer pre-tokens are counted each time, so the cache stays small whatever the texts hold.
CACHE_CHARS = 48
#: Texts beyond this many characters are walked pre-token by pre-token instead of being listed.
LIST_CHARS = 4_000_000

# Fixed value: the split pattern of byte-level BPE pre-tokenisation.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Letters and numbers of the newest Unicode versions, which the libraries of the vocabulary do not know as such yet.
NEWER = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB
11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191
191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""


@functools.cache
def patterns() -> tuple[regex.Pattern, regex.Pattern, regex.Pattern]:
    """(the split, a search for newer letters and numbers, the split for texts that hold some)."""
    newer = "".join("-".join(f"\\U{int(x, 16):08X}" for x in part.split("-")) for part in NEWER.split())
    careful = SPLIT_PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])").replace(r"\p{L}+|", rf"[^\P{{L}}{newer}]+|").replace(r"\p{N}+|", rf"[^\P{{N}}{newer}]+|")
    return regex.compile(SPLIT_PATTERN), regex.compile(f"[{newer}]"), regex.compile(careful)


@functools.cache
def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class MergeCounter(dict):
    """Pre-token -> number of tokens, computed by heap merging when it is first asked for."""

    def __init__(self, vocabulary: bytes):
        super().__init__()
        spec = json.loads(vocabulary)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or model["type"] != "BPE":
            raise ValueError("a byte-level BPE vocabulary without normaliser and prefix space is needed")
        #: Pair of symbols -> rank of its merge; symbols are the bytes, then 256 + the rank that makes them.
        self.rank: dict[tuple[int, int], int] = {}
        symbol = {c: b for b, c in byte_alphabet().items()}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[symbol[left], symbol[right]] = rank
            symbol.setdefault(left + right, 256 + rank)
            if symbol[left + right] != 256 + rank:
                raise ValueError("two merges make the same symbol")
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.split, self.newer, self.careful = patterns()

    def merge(self, data: bytes) -> int:
        """Initial symbols minus merges."""
        symbols, rank = list(data), self.rank.get
        n = len(symbols)
        heap = [r << 32 | i for i, r in enumerate(map(rank, zip(symbols, symbols[1:]))) if r is not None]  # noqa: B905
        merges = 0
        if heap:
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            heapq.heapify(heap)
        while heap:
            key = heapq.heappop(heap)
            i, r = key & 0xFFFFFFFF, key >> 32
            j = after[i]
            if j >= n or symbols[i] < 0 or rank((symbols[i], symbols[j])) != r:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = made, _ = 256 + r, -1
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (r := rank((made, symbols[k]))) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if (h := before[i]) >= 0 and (r := rank((symbols[h], made))) is not None:
                heapq.heappush(heap, r << 32 | h)
        return n - merges

    def __missing__(self, word: str) -> int:
        count = self.merge(word.encode("utf-8", "surrogatepass"))
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = count
        return count

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; strings of added tokens inside it count as one token each."""
        if not text:
            return 0
        total, at = 0, 0
        for m in self.added.finditer(text) if self.added else ():
            total += 1 + self._words(text[at : m.start()])
            at = m.end()
        return total + self._words(text[at:] if at else text)

    def _words(self, text: str) -> int:
        split = self.careful if not text.isascii() and self.newer.search(text) else self.split
        if len(text) <= LIST_CHARS:
            return sum(map(self.__getitem__, split.findall(text)))
        return sum(self[m.group()] for m in split.finditer(text))


@functools.lru_cache(maxsize=2)
def _counter(vocabulary: bytes) -> MergeCounter:
    return MergeCounter(vocabulary)


def token_counter(vocabulary_path: str):
    """An Arrow UDF from a text to its number of tokens. The vocabulary file (a few MB) travels with the task."""
    with open(vocabulary_path, "rb") as file:
        vocabulary = file.read()

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        counter = _counter(vocabulary)
        return pa.array([counter.count(t.as_py()) for t in texts], pa.int64())

    return count


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit.

    A null text is empty: 0 bytes and 0 tokens.  Every row is counted by itself, so repeated rows, ties and
    empty tables need no rule, and texts of any length are counted whole.  Columns of docs called n_bytes,
    n_tokens or over_limit are replaced; others are kept.
    """
    small_batches(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumns({"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": token_counter(vocabulary_path)(whole)})
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
