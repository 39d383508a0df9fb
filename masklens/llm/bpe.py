"""BPE encoding and decoding by dynamic programming over word prefixes.

Byte-pair merging gives every prefix of a word an encoding, and that of a longer prefix ends in a last
token whose removal leaves the encoding of a shorter prefix. So one token per prefix is enough: of the
vocabulary tokens that end at a place (matches of the vocabulary's suffix automaton), the last token is
the one that is compatible with the last token of the prefix before it, that is, merging would never join
across their border. Following the stored tokens from the end of the word back gives the ids.

The new words of a batch are encoded in order, so that a word goes on from the prefix it shares with the one before.

The tokenizer file (word-level BPE with an end-of-word suffix) is a parameter; its normalisation, word
pattern, byte alphabet and special tokens are applied as the file states them.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from masklens.llm.common import worker_state

#: words and pieces between blanks (of each of two generations) and token pairs that a worker remembers
MEMO_WORDS, MEMO_CHUNKS, MEMO_PAIRS = 250_000, 350_000, 700_000
#: longer words and pieces are encoded without being remembered
MEMO_LENGTH = 64
#: texts whose new words are encoded together
TOGETHER = 512
#: below this code point all are assigned, lower-case alone, and letters in every version of the tables
PLAIN = "\u0370"
#: fixed values: letters, digits and lower-case mappings (first, last, distance) of Unicode 16 and 17, which the tokenizers
#: library knows and this Python's tables may not
LATER_LETTERS = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
                 (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
                 (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
                 (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
LATER_DIGITS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
                (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
LATER_LOWER = ((0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
               (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20),
               (0x16EA0, 0x16EB8, 0x1B))


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes are themselves, the others follow 255."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 256
    for b in range(256):
        if b in plain:
            letters.append(chr(b))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


def later_classes() -> dict[int, str]:
    """A letter or a digit that stands for each later one, as the word pattern sees it."""
    return {c: "x" for a, b in LATER_LETTERS for c in range(a, b + 1)} | {c: "0" for a, b in LATER_DIGITS for c in range(a, b + 1)}


class SuffixAutomaton:
    """The suffix automaton of all tokens: every substring of a token is a path, and a state holds the substrings that end at the
    same places. ``length`` is that of a state's longest one, ``link`` the state of the longest suffix that
    ends at more places; ``whole`` is the token that a state's longest one is, ``inner`` the tokens along the links from a
    state (itself included), longest first.
    """

    def __init__(self, tokens: dict[str, int]):
        steps: list[dict[str, int]] = [{}]
        length, link, whole = array("i", [0]), array("i", [-1]), {}
        for token, i in tokens.items():
            last = 0
            for ch in token:
                last = self._extend(steps, length, link, last, ch)
            whole[last] = i
        self.steps, self.length, self.link, self.whole = steps, length, link, whole
        self.inner: list[tuple] = [()] * len(steps)
        for state in sorted(range(1, len(steps)), key=length.__getitem__):  # links lead to shorter ones
            own = whole.get(state)
            self.inner[state] = (() if own is None else ((own, length[state]),)) + self.inner[link[state]]

    @staticmethod
    def _extend(steps: list, length: array, link: array, last: int, ch: str) -> int:
        """The state of ``last``'s longest substring and one more letter."""
        def cloned(p: int, q: int) -> int:
            copy = len(steps)
            steps.append(dict(steps[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            link[q] = copy
            while p >= 0 and steps[p].get(ch) == q:
                steps[p][ch] = copy
                p = link[p]
            return copy

        to = steps[last].get(ch)
        if to is not None:  # another token has it already
            return to if length[to] == length[last] + 1 else cloned(last, to)
        new, p = len(steps), last
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and ch not in steps[p]:
            steps[p][ch] = new
            p = link[p]
        if p >= 0:
            q = steps[p][ch]
            link[new] = q if length[q] == length[p] + 1 else cloned(p, q)
        return new

    def step(self, state: int, matched: int, ch: str) -> tuple[int, int]:
        """The longest suffix of what was matched and one more letter that is a substring of a token: its state and length."""
        steps = self.steps
        to = steps[state].get(ch)
        if to is not None:
            return to, matched + 1
        while state:
            state = self.link[state]
            to = steps[state].get(ch)
            if to is not None:
                return to, self.length[state] + 1
        return 0, 0

    def ending(self, state: int, matched: int) -> tuple:
        """(token, length) of all tokens that end here, longest first."""
        if matched == self.length[state]:
            return self.inner[state]
        # the state's longest substring is longer than what matched; those along the links are shorter
        return self.inner[self.link[state]] if state else ()


class Memo:
    """Packed ids by text, in two generations: what was used since the last turn survives the next one."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def known(self, keys: set) -> tuple[dict, set]:
        """What is remembered of ``keys``, and the others."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = keys.difference(young)
        for key in missing.intersection(old):
            young[key] = old[key]
        missing.difference_update(old)
        get = young.__getitem__
        return {key: get(key) for key in keys.difference(missing)}, missing

    def keep(self, made: dict) -> None:
        self.young.update((k, v) for k, v in made.items() if len(k) <= MEMO_LENGTH)


class PrefixBPE:
    """Exact encoder and decoder for one tokenizer file (its JSON as text)."""

    def __init__(self, spec: str):
        import regex

        told = json.loads(spec)
        model = told["model"]
        kinds = [x["type"] for x in told["normalizer"]["normalizers"]]
        split, to_bytes = told["pre_tokenizer"]["pretokenizers"]
        if (model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or model.get("dropout")
                or model.get("ignore_merges") or model.get("continuing_subword_prefix") or told["decoder"] is not None
                or split["behavior"] != "Removed" or not split["invert"] or to_bytes["add_prefix_space"]):
            raise ValueError("a tokenizer file of another kind")
        space = told["normalizer"]["normalizers"][1]
        self.blank = regex.compile(space["pattern"]["Regex"])
        if space["content"] != " ":
            raise ValueError("a tokenizer file of another kind")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.letters = byte_letters()
        self.table = {i: x for i, x in enumerate(self.letters)}
        vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in told["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # a token's two parts and the rank of the merge that makes it; single letters have none
        self.rank, self.parts = {}, {}
        for r, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = vocab[left], vocab[right]
            whole = vocab[left + right]
            self.rank.setdefault((a, b), r)
            self.parts.setdefault(whole, (a, b, r))
        # the last letter of a word is marked: "x</w>" is one letter, written as x and a mark below
        self.mark = "\0"
        tokens = {}
        for t, i in vocab.items():
            last = t.endswith(self.end) and t != self.end
            plain = t.removesuffix(self.end) + self.mark if last else t
            if i in self.parts or len(plain) - last == 1:
                tokens[plain] = i
        self.automaton = SuffixAutomaton(tokens)
        self.fits: dict[int, bool] = {}
        self.later = later_classes()
        self.lower = {c: chr(c + far) for a, b, far in LATER_LOWER for c in range(a, b + 1)}
        # ids are kept packed; specials are pieces of their own, under their ids
        self.kind = "H" if max(self.token) < 1 << 16 else "I"
        self.width = np.uint16 if self.kind == "H" else np.uint32
        # by id: in decimal, and the token
        self.decimal, self.told = (np.full(max(self.token) + 1, "", dtype=object) for _ in range(2))
        for i, token in self.token.items():
            self.decimal[i], self.told[i] = str(i), token
        self.own = {i: array(self.kind, [i]).tobytes() for i in self.special.values()}
        self.words_seen, self.chunks_seen = Memo(MEMO_WORDS), Memo(MEMO_CHUNKS)

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging the letters of ``a`` and ``b`` side by side ends in these two tokens.

        Undo merges in reverse order of rank: at every moment one piece of ``a`` ends at the border and
        one piece of ``b`` begins there. They would have been joined if their own merge ranks below the
        merge that next takes either of them away (at equal rank the leftmost goes first).
        """
        rank, parts = self.rank, self.parts
        x, y = a, b
        x_until = y_until = 1 << 60  # the rank at which the piece was taken into a larger one
        while True:
            r = rank.get((x, y))
            if r is not None and r < x_until and r <= y_until:
                return False
            px, py = parts.get(x), parts.get(y)
            if px is None and py is None:
                return True
            if py is None or px is not None and px[2] >= py[2]:
                x, x_until = px[1], px[2]
            else:
                y, y_until = py[0], py[2]

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """(word, packed ids) of words of byte letters (not empty), in order."""
        a, fits = self.automaton, self.fits
        steps, lengths, links, inner, step = a.steps, a.length, a.link, a.inner, a.step
        states, matched, last, start = [0], [0], [0], [0]  # by prefix: the automaton's place, the last token and where it starts
        before = ""
        for word in sorted(words):
            n, shared = len(word), 0
            most = min(n, len(before)) - 1  # the last letter is another one: it is marked
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del states[shared + 1:], matched[shared + 1:], last[shared + 1:], start[shared + 1:]
            state, size = states[shared], matched[shared]
            at = shared
            for ch in word[shared:]:
                at += 1
                to = steps[state].get(ch)
                if to is None:
                    state, size = step(state, size, ch)
                else:
                    state, size = to, size + 1
                end = at
                if at == n:  # the last letter and its mark are two steps
                    state, size = step(state, size, self.mark)
                    end = at + 1
                # a state's longest substring may be longer than what matched; those along the links are shorter
                for token, length in inner[state if size == lengths[state] else links[state]] if state else ():
                    begin = end - length
                    if begin:
                        pair = last[begin] << 32 | token
                        fit = fits.get(pair)
                        if fit is None:
                            if len(fits) >= MEMO_PAIRS:
                                fits.clear()
                            fit = fits[pair] = self._compatible(last[begin], token)
                        if not fit:
                            continue
                    break
                else:
                    raise ValueError("a word has a letter that the vocabulary lacks")
                states.append(state)
                matched.append(size)
                last.append(token)
                start.append(begin)
            ids, at = array(self.kind), n
            while at:
                ids.append(last[at])
                at = start[at]
            ids.reverse()
            before = word
            yield word, ids.tobytes()

    def normal(self, chunk: str) -> str:
        """NFC and lower case letter by letter (so no final sigma) of a piece without white space."""
        if chunk.isascii():
            return chunk.lower()
        plain = unicodedata.normalize("NFC", chunk)
        if max(plain) < PLAIN:
            return plain.lower()
        return plain.replace("\u03a3", "\u03c3").lower().translate(self.lower)

    def letters_of(self, word: str) -> str:
        return word if word.isascii() and word.isprintable() else word.encode("utf-8", "replace").decode("latin-1").translate(self.table)

    def words_of(self, chunk: str) -> list[str]:
        """The words, in byte letters, of a piece of text without white space."""
        plain = self.normal(chunk)
        if plain.isascii():
            if plain.isalpha():  # one word, whatever the pattern's other cases are
                return [plain]
            if plain[-1] in ".,;:!?" and plain[:-1].isalpha():  # a word and a symbol
                return [plain[:-1], plain[-1]]
            seen = plain
        elif max(plain) < PLAIN:
            if plain.isalpha():
                return [self.letters_of(plain)]
            seen = plain
        else:  # what the pattern's Unicode tables and the library's do not both know is put into its class
            seen = "".join([self.later.get(ord(c), "\ue000") if unicodedata.category(c) == "Cn" or ord(c) in self.later else c
                            for c in plain])
        return [self.letters_of(plain[m.start():m.end()]) for m in self.words.finditer(seen)]

    def chunks(self, text: str) -> list:
        """The pieces of a whole text between white space, and the ids of special tokens in it."""
        if "<" not in text or not self.cut.search(text):
            return self._split(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self._split(text[at:m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self._split(text[at:])

    def _split(self, text: str) -> list[str]:
        # no word holds white space and no composition crosses it, so pieces between it stand alone;
        # where Python's idea of white space and the file's pattern may part, the pattern splits
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        return [c for c in self.blank.split(text) if c] if odd else text.split()

    def learn(self, chunks: set) -> dict:
        """The packed ids of all pieces; the words of new ones are encoded together."""
        told, new = self.chunks_seen.known(chunks)
        told |= self.own
        split = {chunk: self.words_of(chunk) for chunk in new}
        known, words = self.words_seen.known({w for own in split.values() for w in own})
        fresh = dict(self.encode_words(words))
        self.words_seen.keep(fresh)
        known |= fresh
        made = {chunk: known[own[0]] if len(own) == 1 else b"".join([known[w] for w in own]) for chunk, own in split.items()}
        self.chunks_seen.keep(made)
        return told | made

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of every whole text."""
        lists = [self.chunks(text) for text in texts]
        get = self.learn(set().union(*lists).difference(self.own)).__getitem__
        for own in lists:
            yield np.frombuffer(b"".join(map(get, own)), dtype=self.width)

    def encode(self, text: str) -> list[int]:
        return [*self.encode_all([text])][0].tolist()

    def in_decimal(self, ids) -> str:
        return " ".join(self.decimal[ids].tolist())

    def decode(self, ids) -> str:
        """The tokens joined by blanks, as a tokenizer file without a decoder gives; specials are kept."""
        return " ".join(self.told[np.asarray(ids, dtype=np.int64)].tolist())


def encode_documents(docs: DataFrame, tokenizer_json: str, *, text: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs`` without ``text``, plus ``n_tokens``, ``ids`` (if ``with_ids``), ``ids_sha256``, ``decoded_sha256``.

    ``tokenizer_json`` is the tokenizer file's content. Whole texts are encoded, of any length; ids are
    decoded again and digested. Null and empty texts have no ids; repeated rows are encoded alike; an empty
    table gives an empty result. Other columns pass through; columns named as the results are replaced.

    Narrow: no shuffle. The driver sends the vocabulary (fixed size) with the tasks; a worker builds the
    automaton once and remembers a bounded number of words, as packed ids.
    """
    made = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    rest = docs.drop(*made)
    if not isinstance(rest.schema[text].dataType, StringType):
        raise TypeError(f"{text} is not a string column")
    at = rest.columns.index(text)
    kept = [f for f in rest.schema.fields if f.name != text]
    schema = StructType([*kept, StructField("n_tokens", LongType()),
                         *([StructField("ids", ArrayType(IntegerType()))] if with_ids else []),
                         StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    name = "bpe-" + hashlib.sha256(tokenizer_json.encode()).hexdigest()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = worker_state(name, lambda: PrefixBPE(spec.value))
        for whole in batches:
            for begin in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(begin, TOGETHER)
                sizes, lists, digests, decoded = [], [], [], []
                for ids in bpe.encode_all([value or "" for value in batch.column(at).to_pylist()]):
                    sizes.append(len(ids))
                    if with_ids:
                        lists.append(ids)
                    digests.append(hashlib.sha256(bpe.in_decimal(ids).encode()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                columns = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(sizes, pa.int64())]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                columns += [pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rest.mapInArrow(run, schema)
