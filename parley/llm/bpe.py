"""Operator 6, byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding. A token sequence is the merge result of its bytes exactly when each neighbouring pair is the merge result of its own bytes.
So each prefix of a piece has one last token, and a nondeterministic transducer over the trie of tokens follows every place
where a token may still begin, carrying the tokens up to there. ``Transducer`` determinises it on demand: a state is the set of live
begins (trie node, last token, tokens not yet agreed on); a transition emits the tokens that all live begins agree on, so output
waits for at most the longest token's length. States and transitions are kept in tables of at most ``MAX_TABLE`` entries; beyond them
a step is worked out each time, so a text of any length and kind holds no more. Pieces met before are kept in two generations of ``MAX_PIECES``.

Decoding. Token bytes are appended to ``Utf8Machine``, an incremental UTF-8 state machine that gives out complete characters and
holds at most three bytes of an unfinished one; malformed input gives U+FFFD as Python's ``errors="replace"`` does.

Pieces are the matches of the tokenizer's pattern, each encoded separately; a piece that is itself a token is that token. Null text
counts as empty: no tokens. There are no special tokens. The rank file is a parameter; it is read once on the driver and its
content (bounded by the vocabulary) is sent to the executors.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import common as C

MAX_TABLE = 300_000
MAX_PAIRS = 250_000
MAX_PIECES = 200_000
MAX_PIECE_BYTES = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def last_merge(ranks: dict[bytes, int], token: bytes) -> tuple[bytes, bytes] | None:
    """The two parts whose merge completes ``token`` when its bytes are merged by rank, lowest first and leftmost of ties;
    None if merging its bytes gives something else."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best == 1 << 60:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1])


class Transducer:
    """Bytes to token ids, by transitions that are made when first needed."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.trie: list[dict[int, int]] = [{}]
        self.ends: list[int | None] = [None]
        for t, i in ranks.items():
            node = 0
            for b in t:
                if b not in self.trie[node]:
                    self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(None)
                node = self.trie[node][b]
            self.ends[node] = i
        self.pairs: dict[int, bool] = {}
        self.splits: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.width = max(self.token, default=0) + 1
        self.states: list[tuple] = [((0, None, ()),)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.size = 0

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The last merge of a token; a single byte is its own, None for tokens that merging never makes."""
        if token not in self.splits:
            self.splits[token] = (token, token) if len(token) == 1 else last_merge(self.ranks, token)
        return self.splits[token]

    def fits(self, before: int | None, t: int) -> bool:
        """Whether the two tokens side by side (or t alone) are what merging their bytes gives.

        Merges are undone at the border, the later one first. The pair is not a merge result if the parts that then face each
        other would have merged before the merge that was undone."""
        pair = t if before is None else (before + 1) * self.width + t
        got = self.pairs.get(pair)
        if got is None:
            got = self._fits(None if before is None else self.token[before], self.token[t])
            if len(self.pairs) < MAX_PAIRS:
                self.pairs[pair] = got
        return got

    def _fits(self, left: bytes | None, right: bytes) -> bool:
        if self.split(right) is None or left is not None and self.split(left) is None:
            return False
        if left is None:
            return True
        ranks, undone = self.ranks, 1 << 60
        while True:
            if ranks.get(left + right, 1 << 60) < undone:
                return False
            a = ranks[left] if len(left) > 1 else -1
            b = ranks[right] if len(right) > 1 else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                undone, left = a, self.split(left)[1]
            else:  # of equal ranks the left one merges first, so the right one is undone first
                undone, right = b + 1, self.split(right)[0]

    def move(self, state: int, at: tuple, byte: int) -> tuple[int, tuple, tuple[int, ...]]:
        """The next state's number (-1: not kept) and content, and the tokens emitted, from the content of ``state``."""
        live, last, trie = [], None, self.trie
        for node, before, held in at:  # longest first
            node = trie[node].get(byte)
            if node is None:
                continue
            if last is None:
                t = self.ends[node]
                if t is not None and self.fits(before, t):
                    last = (*held, t)
            if trie[node]:
                live.append((node, before, held))
        agreed, top = 0, len(last)
        for _, _, held in live:
            top = min(top, len(held))
        while agreed < top and all(held[agreed] == last[agreed] for _, _, held in live):
            agreed += 1
        emitted = last[:agreed]
        if agreed:
            live = [(node, before, held[agreed:]) for node, before, held in live]
        key = (*live, (0, last[-1], last[agreed:]))
        to = self.number.get(key, -1)
        if to < 0 and self.size < MAX_TABLE:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.size += len(key)
        if state >= 0 and to >= 0 and self.size < MAX_TABLE:
            self.moves[state][byte] = (to, emitted)
            self.size += 1
        return to, key, emitted

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, at = 0, self.states[0]
        for b in piece:
            step = self.moves[state].get(b) if state >= 0 else None
            if step is None:
                state, at, emitted = self.move(state, at, b)
            else:
                state, emitted = step
                at = self.states[state]
            if emitted:
                out += emitted
        out += at[-1][2]
        return out


class Utf8Machine:
    """Incremental UTF-8: ``feed`` gives the characters that are complete, ``close`` what is left."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def open_bytes(data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes may still complete."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 == 0x80:
                continue
            need = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 1
            if need <= back:
                return 0
            if back > 1:  # the second byte of some leads has a narrower range
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
                if not low <= data[-back + 1] <= high:
                    return 0
            return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        n = self.open_bytes(data)
        self.held = data[len(data) - n:]
        return data[:len(data) - n].decode("utf-8", "replace")

    def close(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


def decode_stream(tokens: dict[int, bytes], ids: Iterable[int], step: int = 4096) -> Iterator[str]:
    """Text of the ids in pieces of complete characters, holding at most ``step`` tokens."""
    machine, buffer = Utf8Machine(), []
    for i in ids:
        buffer.append(tokens[i])
        if len(buffer) == step:
            yield machine.feed(b"".join(buffer))
            buffer.clear()
    yield machine.feed(b"".join(buffer))
    yield machine.close()


class Codec:
    """Texts to ids and back, with a bounded table of pieces met before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.find = regex.compile(pattern).findall
        self.transducer = Transducer(ranks)
        self.seen: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        seen, out = self.seen, []
        for p in self.find(text):
            ids = seen.get(p)
            if ids is None:
                ids = self.older.get(p)
                if ids is None:
                    ids = tuple(self.transducer.encode(p.encode()))
                if len(p) <= MAX_PIECE_BYTES:
                    if len(seen) >= MAX_PIECES:
                        self.older, self.seen = seen, {}
                        seen = self.seen
                    seen[p] = ids
            out.extend(ids)
        return out

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        return decode_stream(self.transducer.token, ids)


def shared_codec(ranks_of: Callable[[], dict[bytes, int]], key: int, pattern: str) -> Codec:
    """One codec in each Python worker."""
    codecs = C.worker_tables("bpe")
    if (key, pattern) not in codecs:
        codecs[key, pattern] = Codec(ranks_of(), pattern)
    return codecs[key, pattern]


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
                  with_decoded: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``with_ids``, ids and (``with_decoded``) decoded of each row of ``docs``."""
    with_decoded = with_ids and with_decoded
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded string" * with_decoded)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = shared_codec(lambda: sent.value, len(sent.value), pattern)
        number = {i: str(i) for i in codec.transducer.token}
        for texts in batches:
            rows = []
            for text in texts:
                ids = codec.encode(text)
                listed, decoded, back = hashlib.sha256(), hashlib.sha256(), []
                listed.update(",".join(map(number.__getitem__, ids)).encode())
                for part in codec.decode(ids):
                    decoded.update(part.encode())
                    if with_decoded:
                        back.append(part)
                rows.append((len(ids), listed.hexdigest(), decoded.hexdigest(), *([ids] * with_ids), *(["".join(back)] * with_decoded)))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:3 + with_ids + with_decoded])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), run(text).alias("r")).select("doc_id", "r.*")


def public_vocabulary(spark: SparkSession | None = None, name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the installed public tokenizer files."""
    import public_tokenizers
    return read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN
