"""BPE encoding and decoding by dynamic programming over prefixes.

Inside a pre-token, the encoding of every prefix ends in one certain token. The last
token of a prefix is the vocabulary token that (1) is a suffix of the prefix, found by
an automaton over the vocabulary, (2) encodes to itself, and (3) can stand after the last
token of the remaining shorter prefix: merging the two spellings would not have joined
across their border. Following the back-pointers from the whole pre-token gives the ids
without replaying any merge.

The vocabulary file is read once by the driver and broadcast (its size does not depend
on the data); each Python worker builds the automaton once and keeps a bounded memo of
chunks. Documents never shuffle: one pass, row by row, over whole texts.

Defined cases: a null text is the empty text (no ids; digest of the empty string); very
long pre-tokens cost time in proportion to their length; repeated rows give repeated
results; other columns of the input are ignored. Code points that Unicode has added since
the tokenizer library's tables may be ordered or classed otherwise than there.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

from pyspark.sql import DataFrame

from dealcast.llm.common import workers_ready

#: Texts that a worker remembers in each generation of a memo, and the longest one remembered.
MEMO_TEXTS, MEMO_CHARS = 150_000, 48

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NO_LIMIT = 1 << 60


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Memo:
    """Results of ``make`` by text: a newer and an older generation of bounded size."""

    def __init__(self, make):
        self.make, self.new, self.old = make, {}, {}

    def get(self, text: str):
        got = self.new.get(text)
        if got is None:
            got = self.old.get(text) or self.make(text)
            if len(text) <= MEMO_CHARS:
                if len(self.new) >= MEMO_TEXTS:
                    self.old, self.new = self.new, {}
                self.new[text] = got
        return got


class PrefixBPE:
    """Encoder and decoder of one byte-level vocabulary with word ends."""

    def __init__(self, spec: str):
        import ahocorasick
        import regex

        spec = json.loads(spec)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        chars = byte_chars()
        # Each base symbol is one character: a byte inside a word, or a byte that ends one.
        self.inner = [chr(0x1000 + b) for b in range(256)]
        self.last = [chr(0x1100 + b) for b in range(256)]
        spelled = {chars[b]: self.inner[b] for b in range(256)}
        if self.end:
            spelled |= {chars[b] + self.end: self.last[b] for b in range(256)}
        else:
            self.last = self.inner
        # Tokens are numbered in the order in which merging makes them: bases, then merges.
        self.names = [t for t in spelled]
        self.spell = [spelled[t] for t in self.names]
        number = {t: k for k, t in enumerate(self.names)}
        self.bases = len(self.names)
        self.parts: list[tuple[int, int] | None] = [None] * self.bases
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            pair = (number[a], number[b])
            if a + b in number:
                raise ValueError(f"two merges make {a + b!r}")
            number[a + b] = self.joined[pair] = len(self.names)
            self.names.append(a + b)
            self.spell.append(self.spell[pair[0]] + self.spell[pair[1]])
            self.parts.append(pair)
        self.ids = [vocab.get(t) for t in self.names]
        self.by_id = {i: t for t, i in vocab.items()}
        self.by_id |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.automaton = ahocorasick.Automaton()
        for k, s in enumerate(self.spell):
            self.automaton.add_word(s, k)
        self.automaton.make_automaton()
        self._fits: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alternatives = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.specials = regex.compile(f"({alternatives})") if alternatives else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # The pattern's \s is Unicode white space.
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}"))
        self.blanks = regex.compile(r"\p{White_Space}+")
        self.chunks = Memo(self.chunk)
        self.words = Memo(self.word_texts)

    def fits(self, a: int, b: int) -> bool:
        """Whether token b can follow token a, that is, no merge joins across their border.

        The two are taken apart in reverse order of their making; at each step the tokens
        that then touched must not have a merge that comes before the step's own.
        """
        got = self._fits.get((a, b))
        if got is None:
            x, y, limit = a, b, NO_LIMIT
            while True:
                made = self.joined.get((x, y))
                if made is not None and made < limit:
                    got = False
                    break
                if x < self.bases and y < self.bases:
                    got = True
                    break
                if x > y:
                    limit, x = x, self.parts[x][1]
                else:  # of equal merges the left one comes first
                    limit, y = y + 1, self.parts[y][0]
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            self._fits[a, b] = got
        return got

    def whole(self, t: int) -> bool:
        """Whether the spelling of token t encodes to t itself."""
        got = self._whole.get(t)
        if got is None:
            got = True
            if t >= self.bases:
                s = [self.spell_number(c) for c in self.spell[t]]
                while len(s) > 1:
                    made = [(self.joined.get(p, NO_LIMIT), k) for k, p in enumerate(zip(s, s[1:]))]
                    rank, k = min(made)
                    if rank == NO_LIMIT:
                        break
                    s[k:k + 2] = [rank]
                got = s == [t]
            self._whole[t] = got
        return got

    def spell_number(self, c: str) -> int:
        k = ord(c) - 0x1000
        return k if k < 256 else self.bases // 2 + k - 256

    def word(self, data: bytes) -> list[int]:
        """Token numbers of one pre-token."""
        text = "".join([self.inner[b] for b in data[:-1]]) + self.last[data[-1]]
        last = [-1] * (len(text) + 1)  # the last token of each prefix
        for end, t in self.automaton.iter(text):
            if last[end + 1] < 0:
                start = end + 1 - len(self.spell[t])
                if (not start or last[start] >= 0 and self.fits(last[start], t)) and self.whole(t):
                    last[end + 1] = t
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= len(self.spell[last[at]])
        return out[::-1]

    def word_texts(self, piece: str) -> tuple[int, str, str]:
        """Number of ids, ids and token texts (both joined by a space) of a pre-token."""
        numbers = self.word(piece.encode())
        return (len(numbers), " ".join([str(self.ids[t]) for t in numbers]), " ".join([self.names[t] for t in numbers]))

    def chunk(self, text: str) -> tuple[int, str, str]:
        """The same of a text without white space."""
        got = [self.words.get(piece) for piece in self.pieces.findall(text)]
        if len(got) == 1:
            return got[0]
        return (sum([g[0] for g in got]), " ".join([g[1] for g in got]), " ".join([g[2] for g in got]))

    def plain(self, text: str, ids: list[str], shown: list[str]) -> int:
        """Encode text without special tokens, appending to ids and shown; returns the number of ids."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        chunks = text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else self.blanks.split(text)
        known, n = self.chunks, 0
        for c in chunks:
            got = known.new.get(c) or known.get(c)
            if got[0]:
                n += got[0]
                ids.append(got[1])
                shown.append(got[2])
        return n

    def encode_joined(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by a space, and the decoded text."""
        ids: list[str] = []
        shown: list[str] = []
        if self.specials is None or not any(s in text for s in self.special):
            n = self.plain(text, ids, shown)
        else:
            n = 0
            for part in self.specials.split(text):
                if part in self.special:
                    n += 1
                    ids.append(str(self.special[part]))
                    shown.append(part)
                else:
                    n += self.plain(part, ids, shown)
        return n, " ".join(ids), " ".join(shown)

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for i in self.encode_joined(text or "")[1].split()]

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by a space (the file names no decoder)."""
        return " ".join(self.by_id[i] for i in ids)


_ENCODERS: dict[int, PrefixBPE] = {}


def _encoder(shared) -> PrefixBPE:
    """The worker's encoder of a broadcast vocabulary file."""
    spec = shared.value
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PrefixBPE(spec)
    return _ENCODERS[key]


def vocabulary(path: str) -> str:
    """The text of a tokenizer file, read by the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text -> doc_id, ids array<int>, decoded string."""
    workers_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        import pyarrow as pa
        enc = _encoder(shared)
        for b in batches:
            ids = [enc.encode(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([enc.decode(i) for i in ids], pa.string())],
                ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text -> doc_id, n_tokens and the digests of the ids and of the decoded text."""
    workers_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        import pyarrow as pa
        enc = _encoder(shared)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            got = [enc.encode_joined(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([sha(g[1]) for g in got], pa.string()), pa.array([sha(g[2]) for g in got], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
