"""Token counts of documents, with a shortcut for words that are one token.

For a tokenizer that drops white space and treats the pieces between on their own, a text's
tokens are those of its pre-tokens.  Two things are proved offline, once per tokenizer file,
by asking the library itself:

* ``whole_tokens``: the strings of the vocabulary that encode alone as exactly one token.
  Such a pre-token counts one, without any merging;
* ``plain_characters``: the characters that the library neither changes (but for lower case)
  nor cuts otherwise than the pattern here.  Both are decided character by character, so
  texts of such characters can be cut here.

Only what is neither is encoded: pre-tokens that are several tokens (merged once each, and
remembered up to a number of bytes), and words with other characters or special strings,
which go to the library as they are.  A word ends at ASCII white space, which composes with no
character and lies in no special string, so words can be taken out of a text.  A tokenizer
file of another make gets no shortcut: its texts go to the library whole.

Counting is a narrow pass: nothing is shuffled, texts are never cut short, and the pre-tokens
of a long text are taken in portions.

Cases: null text is empty (0 bytes, 0 tokens); null or repeated ids are counted row by row; a
very long text without white space is taken in portions too if its characters are plain (else
the library takes it as one word); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.fim import groups

LIMIT = 2048
PORTION = 1 << 17  # pre-tokens at a time
CACHE_BYTES = 16 << 20  # of remembered pre-tokens and words

# How tokenizer files of this make cut text, and the same in Python's syntax
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+"

# Characters that are put to the proof: Latin, general punctuation, currency.  None of them is
# the second character of a canonical composition.
_CANDIDATES = [*range(0x09, 0x0E), *range(0x20, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F),
               *range(0x20A0, 0x20C1)]


@dataclass(frozen=True)
class Proof:
    """What was proved of a tokenizer file; ``plain`` is None if there is no shortcut."""

    path: str
    whole: frozenset[str] = field(default=frozenset(), repr=False)
    plain: str | None = None
    special: tuple[str, ...] = ()


def _by_word(spec: dict) -> bool:
    """Does the file drop white space and encode what the pattern matches piece by piece?"""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    changes = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    return ([x.get("type") for x in steps] == ["Split", "ByteLevel"]
            and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
            and (steps[0].get("pattern") or {}).get("Regex") == _SPLIT
            and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex")
            and changes == ["NFC", "Replace", "Lowercase"] and spec.get("post_processor") is None
            and not any(spec["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix"))
            and not any(re.search(r"\s", x["content"]) or x["normalized"] or x["single_word"]
                        for x in spec.get("added_tokens", [])))


def _piece_encoder(path: str):
    """The library's model for pre-tokens: nothing is normalized or cut any more."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True  # pre-tokens hold none
    t.normalizer = normalizers.Sequence([])
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return t


def byte_characters() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves; the other bytes follow in order from 256.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def whole_tokens(path: str) -> frozenset[str]:
    """Strings that the library, asked alone, encodes as the one vocabulary entry they are."""
    with open(path) as f:
        model = json.load(f)["model"]
    end = model.get("end_of_word_suffix") or ""
    of = byte_characters()
    found: dict[str, int] = {}
    for token, number in model["vocab"].items():
        if token.endswith(end) and all(c in of for c in token.removesuffix(end)):
            raw = bytes(of[c] for c in token.removesuffix(end))
            try:
                found[raw.decode()] = number
            except UnicodeDecodeError:  # a part of a character is no pre-token
                continue
    found.pop("", None)
    texts = list(found)
    encoded = _piece_encoder(path).encode_batch_fast(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, encoded) if e.ids == [found[t]])


def plain_characters(path: str) -> str:
    """The candidates that the library handles as the pattern here does, next to any others."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    cut = re.compile(_PARTS)
    out = []
    for c in map(chr, _CANDIDATES):
        good = True
        for text in (c, c + c, f"x{c}x", f"7{c}7", f"!{c}!", f"'{c}", f"é{c}é"):
            theirs = [text[i:j] for i, j in _pieces(t, text)]
            good = good and [p.lower() for p in theirs] == cut.findall(text.lower())
        small = t.normalizer.normalize_str(f"x{c}x")[1:-1]
        if good and (small == c.lower() or c.isspace() and small == " "):
            out.append(c)
    return "".join(out)


def _pieces(t, text: str) -> list[tuple[int, int]]:
    """Where the library's pre-tokens lie; lower case and white space keep places as they are."""
    return [span for _, span in t.pre_tokenizer.pre_tokenize_str(_same_length(t, text))]


def _same_length(t, text: str) -> str:
    out = t.normalizer.normalize_str(text)
    return out if len(out) == len(text) else text


def prove(path: str) -> Proof:
    """The offline step: what the shortcut may rely on for the file at ``path``."""
    if not path.endswith(".json"):
        return Proof(path)
    with open(path) as f:
        spec = json.load(f)
    special = tuple(x["content"] for x in spec.get("added_tokens", []))
    if not _by_word(spec):
        return Proof(path, special=special)
    return Proof(path, whole_tokens(path), plain_characters(path), special)


class TokenCounter:
    """Numbers of tokens of texts, as the library gives them for the proved file."""

    def __init__(self, proof: Proof):
        self.proof = proof
        if proof.path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=proof.path)
            self.library = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(proof.path)
            t.no_truncation()
            t.no_padding()
            self.library = lambda texts: [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
        if proof.plain is not None:
            characters = re.escape(proof.plain)
            self.plain = re.compile(f"[{characters}]*").fullmatch
            self.cut = re.compile(_PARTS).finditer
            self.cut_all = re.compile(_PARTS).findall
            self.words = re.compile(r"[^\x20\x09-\x0D]+").findall
            pieces = _piece_encoder(proof.path)
            self.merge = lambda texts: [len(e.ids) for e in pieces.encode_batch_fast(texts, add_special_tokens=False)]
            self.merged, self.odd = Remembered(self.merge), Remembered(self.library)

    def _portions(self, text: str) -> Iterator[list[str]]:
        if len(text) <= 4 * PORTION:
            yield self.cut_all(text)
            return
        found = (m[0] for m in self.cut(text))
        while part := list(islice(found, PORTION)):
            yield part

    def _usual(self, text: str) -> bool:
        return self.plain(text) is not None and not any(s in text for s in self.proof.special)

    def _taken_apart(self, text: str) -> Iterator[tuple[int, list[str], list[str]]]:
        """Whole tokens, pre-tokens to merge, and words for the library, portion by portion."""
        odd: list[str] = []
        if not self._usual(text):
            words = self.words(text)
            odd = [w for w in words if not self._usual(w)]
            text = " ".join(w for w in words if self._usual(w))
        whole = self.proof.whole
        for part in self._portions(text.lower()):
            rest = [p for p in part if p not in whole]
            yield len(part) - len(rest), rest, odd
            odd = []

    def counts(self, texts: Iterable[str | None]) -> list[int]:
        """Tokens of each text; what several texts have in common is encoded once."""
        if self.proof.plain is None:
            return [self.library([t])[0] if t else 0 for t in texts]
        totals: list[int] = []
        owners: list[int] = []
        rests: list[list[str]] = []
        odds: list[list[str]] = []
        size = 0

        def settle() -> None:
            for lists, known in ((rests, self.merged), (odds, self.odd)):
                known.learn({x for items in lists for x in items})
                for i, items in zip(owners, lists):
                    totals[i] += sum(map(known.counts.__getitem__, items))
                lists.clear()
            owners.clear()

        for i, text in enumerate(texts):
            totals.append(0)
            for whole, rest, odd in self._taken_apart(text or ""):
                totals[i] += whole
                owners.append(i)
                rests.append(rest)
                odds.append(odd)
                size += len(rest) + len(odd)
                if size >= PORTION:
                    settle()
                    size = 0
        settle()
        return totals

    def count(self, text: str) -> int:
        return self.counts([text])[0]


class Remembered:
    """Numbers of tokens of strings; forgotten as a whole when they take too many bytes."""

    def __init__(self, encode):
        self.encode, self.counts, self.size = encode, {}, 0

    def learn(self, items: set[str]) -> None:
        new = items.difference(self.counts)
        size = sum(map(len, new))
        if self.size + size > CACHE_BYTES:
            self.counts, new = {}, items
            self.size, size = 0, sum(map(len, items))
        self.size += size
        listed = list(new)
        self.counts.update(zip(listed, self.encode(listed)))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, proof: Proof | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, a row per document.

    ``proof`` may come from an earlier ``prove(path)``; it is bounded by the vocabulary.
    """
    proof = proof or prove(path)

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = TokenCounter(proof)
        for batch in batches:
            for part in groups(batch, "text"):
                n = counter.counts(t.as_py() for t in part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))
    counted = rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
