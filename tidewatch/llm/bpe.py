"""BPE encoding and decoding (operator 7).

Backtracking encoder: an Aho-Corasick automaton over the vocabulary gives the
longest token at every position of a word; a token is accepted when it is
compatible with its predecessor, that is when merging the two tokens' own
symbols by rank would leave exactly that border.  A dead end marks its
position and steps back to the next shorter prefix token.  Every position is
marked at most once, so the work is linear in the word.  Ids equal those of
rank-ordered merging.  Decoding gathers bytes through an offset table.

Defined results: null text is empty; an empty text has no ids and decodes to
''.  Strings of special tokens inside a text become their ids, as in the
library.  Texts of any length are encoded whole, words one by one.
"""
from __future__ import annotations

import hashlib
import json
import unicodedata
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

_END = 0x1000  # added to a word's last symbol, which carries the word-end mark
_OUT_BYTES = 4 << 20
#: str.split() takes these for white space, the tokenizer does not
_ODD_SPACE = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 as it is, others from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class WordBPE:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, spec: str, cache_words: int = 200_000):
        t = json.loads(spec)
        m = t["model"]
        self.suffix = m.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = m["vocab"]
        size = 1 + max([*vocab.values(), *(x["id"] for x in t["added_tokens"])])
        self.shown = [""] * size
        for s, i in vocab.items():
            self.shown[i] = s
        self.special = {x["content"]: x["id"] for x in t["added_tokens"]}
        for s, i in self.special.items():
            self.shown[i] = s
        self.special_re = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                         + ")") if self.special else None)
        pats = [p["pattern"]["Regex"] for p in t["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pieces = regex.compile(pats[0]).findall
        self.rank: dict[tuple[int, int], int] = {}
        self.left = list(range(size))
        self.right = list(range(size))
        for r, (a, b) in enumerate(m["merges"]):
            new = vocab[a + b]
            self.rank[vocab[a], vocab[b]] = r
            self.left[new], self.right[new] = vocab[a], vocab[b]
        made = {vocab[a + b]: r for r, (a, b) in enumerate(m["merges"])}
        self.made = [made.get(i, -1) for i in range(size)]
        self.key = [""] * size
        self.auto = ahocorasick.Automaton()
        for s, i in vocab.items():
            self.key[i] = self._mark(s)
            self.auto.add_word(self.key[i], i)
        self.auto.make_automaton()
        self.size = [len(k) for k in self.key]
        of = {k: i for i, k in enumerate(self.key) if k}
        self.shorter = [-1] * size  # longest token that is a proper prefix
        for i, k in enumerate(self.key):
            for n in range(len(k) - 1, 0, -1):
                if k[:n] in of:
                    self.shorter[i] = of[k[:n]]
                    break
        self.pair: dict[tuple[int, int], bool] = {}
        self.symbols = byte_symbols()
        raw = [(" " + s).encode() for s in self.shown]
        self.offset = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.cache = _Words(self, cache_words)

    def _mark(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            s = token[: -len(self.suffix)]
            return s[:-1] + chr(ord(s[-1]) + _END)
        return token

    def compatible(self, a: int, b: int) -> bool:
        """No merge across the border of a|b comes before the merges that build a and b.

        Walks the symbols that face each other at the border from the whole
        tokens down to single bytes: of the two, the one made later is taken
        apart, and the facing pair at each level must not merge earlier than
        the moment at which one of them was used up.  Of equal ranks the
        leftmost merge comes first.
        """
        known = self.pair.get((a, b))
        if known is not None:
            return known
        made, key = self.made, (a, b)
        until, ok = 1 << 60, True  # a pair facing now must not merge before `until`
        while True:
            r = self.rank.get((a, b))
            if r is not None and r < until:
                ok = False
                break
            if made[a] < 0 and made[b] < 0:
                break
            if made[a] > made[b]:
                until, a = made[a], self.right[a]
            elif made[b] > made[a]:
                until, b = made[b] + 1, self.left[b]  # the border's merge stands further left than b's own
            else:  # made by the same merge: the left one is done first
                until, b = made[b] + 1, self.left[b]
        if len(self.pair) >= 2_000_000:
            self.pair.clear()
        self.pair[key] = ok
        return ok

    def word(self, piece: str) -> list[int]:
        """Ids of one piece.  ``iter_long`` gives the chain of longest tokens
        from a position on; it is followed for as long as neighbours agree."""
        if piece.isascii() and piece.isprintable():
            w = piece
        else:
            w = "".join([self.symbols[x] for x in piece.encode()])
        if self.suffix:
            w = w[:-1] + chr(ord(w[-1]) + _END)
        n, size, pairs = len(w), self.size, self.pair
        out: list[int] = []
        pos, dead = 0, None
        chain = [t for _, t in self.auto.iter_long(w)]
        step = 0
        while pos < n:
            if step < len(chain):
                tok = chain[step]
                step += 1
            else:
                chain, step = [t for _, t in self.auto.iter_long(w, pos)], 1
                tok = chain[0]
            first = tok
            while tok >= 0:
                if dead is None or not dead[pos + size[tok]]:
                    if not out:
                        break
                    ok = pairs.get((out[-1], tok))
                    if ok or ok is None and self.compatible(out[-1], tok):
                        break
                tok = self.shorter[tok]
            if tok >= 0:
                out.append(tok)
                pos += size[tok]
                if tok != first:
                    chain, step = (), 0
            else:
                if dead is None:
                    dead = bytearray(n + 1)
                dead[pos] = 1
                tok = out.pop()
                pos -= size[tok]
                chain, step = (tok,), 0
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.special_re is not None and self.special_re.search(text):
            parts = self.special_re.split(text)
        else:
            parts = [text]
        get, out = self.cache.__getitem__, []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                # no piece holds white space, so the words between it are looked up whole
                words = part.split() if _ODD_SPACE.search(part) is None else self.pieces(part)
                out.extend(map(get, words))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the tokens joined by spaces, special ones included."""
        a, out = np.frombuffer(ids, "<u4").astype(np.int64), []
        for i in range(0, len(a), 1 << 16):
            x = a[i:i + (1 << 16)]
            start = self.offset[x]
            n = self.offset[x + 1] - start
            at = np.cumsum(n)
            where = np.repeat(start - at + n, n)
            where += np.arange(len(where))
            out.append(self.bytes[where].tobytes())
        return b"".join(out)[1:]


class _Words(dict):
    """Packed ids by word; emptied when full, so memory is bounded."""

    def __init__(self, model: WordBPE, most: int):
        super().__init__()
        self.model, self.most = model, most

    def __missing__(self, w: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        model = self.model
        if w.isalpha():
            got = pack(f"<{len(ids := model.word(w))}I", *ids)
        else:
            p = model.pieces(w)
            got = pack(f"<{len(ids := model.word(w))}I", *ids) if p == [w] else b"".join([self[x] for x in p])
        if len(w) <= 64:
            self[w] = got
        return got


_models: dict[str, WordBPE] = {}


def _model(name: str, spec) -> WordBPE:
    """The worker's model; built once for each tokenizer, not for each task."""
    if name not in _models:
        _models.clear()
        _models[name] = WordBPE(spec.value)
    return _models[name]


def encode_decode(docs: DataFrame, tokenizer_json: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids, decoded) of every text; no shuffle.

    ``ids`` is binary, little-endian unsigned 32-bit integers; ``decoded`` is
    what those ids decode to.  ``tokenizer_json``: path of the tokenizer file,
    read on the driver (a vocabulary, of fixed size) and broadcast.
    """
    with open(tokenizer_json, encoding="utf-8") as f:
        content = f.read()
    spec = docs.sparkSession.sparkContext.broadcast(content)
    name = hashlib.sha256(content.encode()).hexdigest()
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens bigint, ids binary, decoded string"
    arrow = None

    def run(batches):
        model = _model(name, spec)
        keys, ids, shown, size = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, arrow), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(shown, pa.binary()).cast(pa.string())],
                [key, "n_tokens", "ids", "decoded"])

        nonlocal arrow
        for b in batches:
            arrow = b.column(key).type
            for k, t in zip(b.column(key).to_pylist(), b.column(text)):
                i = model.encode(t.as_py() or "")
                keys.append(k)
                ids.append(i)
                shown.append(model.decode(i))
                size += 2 * len(i) + len(shown[-1])
                if size >= _OUT_BYTES:
                    yield flush()
                    keys, ids, shown, size = [], [], [], 0
        if keys:
            yield flush()

    return docs.select(key, text).mapInArrow(run, schema)
