"""BPE encoding by speculation and verification, and decoding.

Speculate: each word is cut greedily into the longest tokens of the vocabulary.
Verify: a cut into tokens is what the merges give exactly if every adjacent pair
of tokens is compatible, that is if no merge would have joined them. Merges
happen in the order of their ranks, so a token's last symbol runs through the
nodes of its right spine, its first symbol through those of its left spine, each
until the merge that takes it up; a pair (A, B) is incompatible if some node of
A's right spine and some node of B's left spine have a merge of a rank below
those that take the two up. All pairs of a batch are tested at once on arrays.
Only words with a failing pair are merged exactly (lowest rank first, leftmost
of equals).

Normalising and splitting into words is the vocabulary's own; ids are kept per
word in a store of bounded size. Nothing is shuffled: a
lost executor's tasks read and encode their rows again.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Shared, fresh, per_text

#: A rank above all merges.
NEVER = 2**31 - 1
#: Longer words are merged with a heap.
SHORT = 32
#: Below END_OF_LATIN stand the basic, Latin-1 and first extended Latin characters: all normal forms whose
#: lower case is one character there, but for the dotted I.
END_OF_LATIN = "\u0180"
#: Characters that Python takes for white space and the tokenizers don't; with them, all that is not plain Latin.
SPACES = re.compile("[\x1c-\x1f]")
ODD = re.compile(f"[\x1c-\x1f\u0130{END_OF_LATIN}-\U0010ffff]")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself where Latin-1
    has a visible one, else the next free character from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def latin_words() -> re.Pattern:
    """The words of lower-cased text below END_OF_LATIN, for the vocabularies
    that are split by white space first."""
    kind = lambda k: "".join(re.escape(chr(c)) for c in range(ord(END_OF_LATIN)) if unicodedata.category(chr(c))[0] == k)
    letters, numbers = kind("L"), kind("N")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+")


LATIN_WORDS = latin_words()
#: From bytes read as Latin-1 to the byte alphabet.
ALPHABET = byte_alphabet()


class Merges:
    """The merges by rank: ``ranks`` of token pairs (left * size + right) and
    what each rank makes."""

    def __init__(self, size: int, rules: list[tuple[int, int, int]]):
        self.size = size
        self.ranks = {a * size + b: rank for rank, (a, b, _) in enumerate(rules)}
        self.made = [m for _, _, m in rules]

    def ids(self, symbols: list[int]) -> list[int]:
        """What the merges make of the symbols: the lowest rank first, the
        leftmost of equals (all pairs' ranks side by side; for short words)."""
        size, get, made = self.size, self.ranks.get, self.made
        ids = list(symbols)
        ranks = [get(a * size + b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            rank = min(ranks)
            if rank == NEVER:
                break
            i = ranks.index(rank)
            ids[i:i + 2] = [made[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] * size + ids[i], NEVER)
            if i < len(ranks):
                ranks[i] = get(ids[i] * size + ids[i + 1], NEVER)
        return ids

    def nodes(self, symbols: list[int]) -> list[tuple]:
        """``ids`` by a heap (long words), as (id, left node, right node); a base
        symbol has no children."""
        nodes: list = [(s, None, None) for s in symbols]
        after = [*range(1, len(nodes)), -1]
        before = list(range(-1, len(nodes) - 1))
        heap: list[tuple[int, int]] = []

        def offer(i: int) -> None:
            if after[i] >= 0:
                rank = self.ranks.get(nodes[i][0] * self.size + nodes[after[i]][0])
                if rank is not None:
                    heapq.heappush(heap, (rank, i))

        for i in range(len(nodes)):
            offer(i)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if nodes[i] else -1
            if j < 0 or self.ranks.get(nodes[i][0] * self.size + nodes[j][0]) != rank:  # a neighbour has changed since
                continue
            nodes[i], nodes[j] = (self.made[rank], nodes[i], nodes[j]), None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [n for n in nodes if n]


class Rules:
    """What a vocabulary file says, as plain values and arrays (built on the
    driver, broadcast: the size of the vocabulary, whatever the data)."""

    def __init__(self, spec: str):
        form = json.loads(spec)
        model = form["model"]
        plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        added = form.get("added_tokens") or []
        if model["type"] != "BPE" or not plain or any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("only byte-level BPE vocabularies with plainly matched added tokens are supported")
        self.spec = spec
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {a["content"]: a["id"] for a in added}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.strings: list[str | None] = [None] * size
        for word, i in {**vocab, **self.added}.items():
            self.strings[i] = word
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.merges = Merges(size, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.base = {c: vocab[c] for c in ALPHABET.values()}
        self.last = {c: vocab[c + self.suffix] for c in ALPHABET.values()}
        # a token may be proposed only if the merges make it of its own symbols
        nodes = {}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for word, i in vocab.items():
            ends = bool(self.suffix) and word.endswith(self.suffix)
            shown = word[:len(word) - len(self.suffix)] if ends else word
            if not shown or any(c not in self.base for c in shown):
                continue
            made = self.merges.nodes(self.symbols(shown) if ends or not self.suffix else [self.base[c] for c in shown])
            if len(made) == 1 and made[0][0] == i:
                nodes[i] = made[0]
                (self.final if ends else self.inner)[shown] = i
        if not self.suffix:
            self.final = self.inner
        self.spines(size, nodes)
        keys = np.fromiter(self.merges.ranks, dtype=np.int64)
        ranks = np.fromiter(self.merges.ranks.values(), dtype=np.int32)
        order = np.argsort(keys)
        self.size, self.pair_keys, self.pair_ranks = size, keys[order], ranks[order]

    def symbols(self, word: str) -> list[int]:
        return [*(self.base[c] for c in word[:-1]), self.last[word[-1]]]

    def spines(self, size: int, nodes: dict[int, tuple]) -> None:
        """Per token the nodes of its right and left spine from the root down
        (-1: no more) and the rank of the merge that takes each up."""
        def walk(side: int):
            lines = {}
            for i, node in nodes.items():
                line, taken = [], NEVER
                while node is not None:
                    line.append((node[0], taken))
                    if node[1] is not None:
                        taken = self.merges.ranks[node[1][0] * size + node[2][0]]
                    node = node[side]
                lines[i] = line
            width = max(map(len, lines.values()), default=1)
            ids, ends = np.full((size, width), -1, dtype=np.int32), np.zeros((size, width), dtype=np.int32)
            for i, line in lines.items():
                ids[i, :len(line)] = [n for n, _ in line]
                ends[i, :len(line)] = [t for _, t in line]
            return ids, ends

        self.right_ids, self.right_ends = walk(2)
        self.left_ids, self.left_ends = walk(1)

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merges leave each token pair apart, all pairs at once."""
        good = np.ones(len(left), dtype=bool)
        if not len(self.pair_keys):
            return good
        for i in range(self.right_ids.shape[1]):
            rows = np.flatnonzero(good & (self.right_ids[left, i] >= 0))
            if not len(rows):
                break
            a, a_end = self.right_ids[left[rows], i].astype(np.int64), self.right_ends[left[rows], i]
            for j in range(self.left_ids.shape[1]):
                b = self.left_ids[right[rows], j]
                here = b >= 0
                if not here.any():
                    break
                rows, a, a_end, b = rows[here], a[here], a_end[here], b[here]
                keys = a * self.size + b
                at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
                rank = np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)
                # of equal merges the leftmost comes first: one inside the left token before, one inside the right token after
                bad = (rank < a_end) & (rank <= self.left_ends[right[rows], j]) & (rank != NEVER)
                good[rows[bad]] = False
        return good


class Store:
    """What a worker has learned, in two generations of bounded size: when the
    younger is full it becomes the elder, and what nobody asks for until the next
    change is forgotten with that."""

    def __init__(self, room: int):
        self.room, self.now, self.elder = room, {}, {}

    def missing(self, keys) -> list[str]:
        """The keys not known; the others are in ``now`` afterwards."""
        out = []
        for k in keys:
            if k not in self.now:
                v = self.elder.get(k)
                if v is None:
                    out.append(k)
                else:
                    self.now[k] = v
        return out

    def age(self) -> None:
        if len(self.now) > self.room:
            self.now, self.elder = {}, self.now


class Encoder:
    """Encodes and decodes texts in one worker."""

    def __init__(self, rules: Rules, room: int = 250_000):
        from tokenizers import Tokenizer

        self.rules = rules
        form = json.loads(rules.spec)
        tokenizer = Tokenizer.from_str(rules.spec)
        self.normalizer, self.splitter, self.decoder = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.decoder
        self.special = re.compile("|".join(re.escape(s) for s in sorted(rules.added, key=len, reverse=True)) or r"(?!)")
        self.longest: dict[str, int] = {}
        for s in rules.inner:
            self.longest[s[0]] = max(len(s), self.longest.get(s[0], 0))
        self.longest_final = max(map(len, rules.final), default=0)
        self.words = Store(room)
        # Where the vocabulary's own steps are these, words of Latin text are found without its help.
        split = (form.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [x.get("type") for x in (form.get("normalizer") or {}).get("normalizers", [])]
        self.latin = (kinds == self.NORMAL and split[0].get("pattern") == {"Regex": self.PATTERN} and split[0].get("invert")
                      and [x.get("type") for x in split] == ["Split", "ByteLevel"] and not split[1]["add_prefix_space"])

    #: The normaliser and the words of the vocabularies that are split by white space first.
    NORMAL = ["NFC", "Replace", "Lowercase"]
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    # A word's key is the word itself, in lower case, where it is found by LATIN_WORDS; else the word in
    # the byte alphabet behind SPLIT. A special token's is its string behind TOKEN.
    SPLIT, TOKEN = "\n", "\r"

    def split(self, text: str) -> list[str]:
        """The keys of a text without special tokens."""
        if self.latin:
            odd = ODD.search(text)
            if odd is None:
                return LATIN_WORDS.findall(text.lower())
            if not SPACES.search(text):  # white space parts words whatever they are
                chunks = text.split()
                if len(chunks) > 1:
                    return [k for c in chunks for k in self.split(c)]
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return [self.SPLIT + w for w, _ in self.splitter.pre_tokenize_str(text)] if text else []

    def parts(self, text: str) -> list[str]:
        """The keys of a text."""
        if not any(s in text for s in self.rules.added):
            return self.split(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self.split(text[at:m.start()]), self.TOKEN + m[0]]
            at = m.end()
        return out + self.split(text[at:])

    def propose(self, word: str) -> list[int]:
        """The longest token at each place."""
        inner, final, longest = self.rules.inner, self.rules.final, self.longest
        out, i, n = [], 0, len(word)
        while True:
            if n - i <= self.longest_final:
                last = final.get(word[i:])
                if last is not None:
                    out.append(last)
                    return out
            k = min(longest[word[i]], n - i - 1)
            while (token := inner.get(word[i:i + k])) is None:
                k -= 1
            out.append(token)
            i += k

    def verify(self, proposals: list[list[int]]) -> np.ndarray:
        """Which proposals have only compatible pairs."""
        counts = np.fromiter(map(len, proposals), dtype=np.int64, count=len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), dtype=np.int64, count=int(counts.sum()))
        of = np.repeat(np.arange(len(proposals)), counts)
        inside = np.flatnonzero(of[:-1] == of[1:])
        keys, which = np.unique(flat[inside] * self.rules.size + flat[inside + 1], return_inverse=True)
        bad = ~self.rules.compatible(keys // self.rules.size, keys % self.rules.size)[which]
        good = np.ones(len(proposals), dtype=bool)
        good[of[inside[bad]]] = False
        return good

    def learn(self, keys: list[str]) -> None:
        """Ids of new words: proposed, verified together, merged exactly where that fails."""
        words = []
        for k in keys:
            if k[0] == self.TOKEN:
                self.words.now[k] = array("i", [self.rules.added[k[1:]]]).tobytes()
            else:
                words.append(k)
        shown = [w[1:] if w[0] == self.SPLIT else w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(ALPHABET)
                 for w in words]
        proposals = [self.propose(w) for w in shown]
        for k, w, ids, good in zip(words, shown, proposals, self.verify(proposals).tolist() if words else ()):
            if not good:
                symbols, merges = self.rules.symbols(w), self.rules.merges
                ids = merges.ids(symbols) if len(w) <= SHORT else [n[0] for n in merges.nodes(symbols)]
            self.words.now[k] = array("i", ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as int32; null counts as empty."""
        self.words.age()
        collecting = gc.isenabled()
        gc.disable()  # many small lists, no cycles
        try:
            cut = [self.parts(t) if t else [] for t in texts]
            get = self.words.now.get
            new: set[str] = set()
            for c in cut:
                if None in map(get, c):
                    new.update([x for x in c if get(x) is None])
            self.learn(self.words.missing(new))
            return [b"".join(map(get, c)) for c in cut]
        finally:
            if collecting:
                gc.enable()

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, special tokens included; ids without a token are skipped."""
        strings = self.rules.strings
        tokens = [s for s in (strings[i] if 0 <= i < len(strings) else None for i in ids) if s is not None]
        return " ".join(tokens) if self.decoder is None else self.decoder.decode(tokens)


BOTH = "struct<ids:array<int>,decoded:string>"
BOTH_ARROW = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
#: Characters that a worker encodes at a time.
SLICE = 2_000_000


def _encode(encoder: Encoder, texts: list[str | None]) -> pa.Array:
    """Ids and, from these, the decoded text, in the same worker."""
    found = encoder.encode(texts)
    ends = np.cumsum([0, *(len(x) // 4 for x in found)])
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), dtype=np.int32), pa.int32()))
    decoded = pa.array([encoder.decode(array("i", x).tolist()) for x in found], pa.string())
    return pa.StructArray.from_arrays([ids, decoded], fields=list(BOTH_ARROW))


def shared_rules(docs: DataFrame, tokenizer_path: str) -> Shared:
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    return Shared(docs.sparkSession, Rules(spec), Encoder, "bpe " + hashlib.sha256(spec.encode()).hexdigest())


def decode(ids: Column, shared: Shared) -> Column:
    """The text of a column of ids (for ids that come from elsewhere); null counts as none."""
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = shared.get()
        for column in columns:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
            flat = column.flatten().to_numpy()
            yield pa.array([encoder.decode(flat[a:b].tolist()) for a, b in zip([0, *ends], ends)], pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()(ids)


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``docs`` with two more columns, ids (array of int) and decoded (their
    text); other columns of these names are replaced.

    A null text counts as empty: no ids, decoded as the empty text. Texts are
    encoded whole, whatever their length; special tokens that stand in a text
    become their ids, as the tokenizers library does it. Repeated rows, null ids
    of documents and extra columns pass through; an empty table stays empty.
    Memory per worker: one slice of the Arrow batch and the two stores."""
    shared = shared_rules(docs, tokenizer_path)
    both = fresh("_both", docs.columns)
    keep = [f"`{c}`" for c in docs.columns if c.lower() not in ("ids", "decoded")]
    found = per_text(shared, _encode, BOTH, BOTH_ARROW, SLICE)(F.col("text").cast("string")).alias(both)
    return docs.select(*keep, found).select(*keep, f"{both}.ids", f"{both}.decoded")


def digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space) and
    decoded_sha256 of every document."""
    full = encode(docs.select("doc_id", "text"), tokenizer_path)
    return full.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
