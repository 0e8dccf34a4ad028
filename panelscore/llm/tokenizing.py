"""Public tokenizer files, and the units of a text that tokenizers treat independently.

A unit is a run of spaces and line ends with the run of other characters behind it. A byte-level BPE with the usual splitting
pattern never joins across the start of such a run, and neither does a sentencepiece BPE none of whose pieces holds a
space or line end behind another character. So a text's tokens are its units' tokens in a row, and a unit seen before
need not be encoded again. Texts with other white space (tabs, no-break spaces and the like) are not cut: a white space
run that only partly consists of spaces is split elsewhere by the pattern.

Tokenizer files are named by a path, or by a file name of the installed public tokenizers; executors open them by that name.
"""
from __future__ import annotations

import functools
import json
import os
import re

_UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: white space but space and line end, and two characters that some Unicode versions count as white space
_ODD = re.compile("[^\\S \\n]|[\u180e\ufeff]")
_ODD_ONES = [chr(c) for c in range(0x10000) if _ODD.match(chr(c))]
_ODD_ASCII = [c for c in _ODD_ONES if c.isascii()]
#: characters outside the blocks where Unicode versions agree on what is a letter, a number and white space (held against the
#: tokenizer's own splitting in the tests): Latin to Cyrillic, general punctuation, East Asian scripts, Hangul
_UNSURE = re.compile("[^\u0000-\u052f\u2000-\u206f\u3000-\u9fff\uac00-\ud7a3]")
#: units kept for reuse in a task's process
UNITS_KEPT = 300_000


def file_path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def byte_bpe(name: str, plain_specials: bool):
    """The ``tokenizers`` object of a .json file without truncation and padding; ``plain_specials``: special strings are plain text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(file_path(name))
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = plain_specials
    return t


@functools.lru_cache(maxsize=4)
def sentences(name: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=file_path(name))


def splits_at_units(tokenizer) -> bool:
    """True for a byte-level BPE without normaliser and prefix space that splits by the usual pattern."""
    parts = json.loads(tokenizer.to_str())
    pre = parts["pre_tokenizer"] or {}
    return parts["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")


def pieces_respect_units(processor) -> bool:
    """True if no piece holds a space or line end behind another character, other than in runs of spaces."""
    return not any(re.search("[^\u2581][\u2581 \n]|\u2581[ \n]", processor.id_to_piece(i)) for i in range(processor.get_piece_size()))


def units(text: str) -> list[str] | None:
    """The units of a text, or None where it holds other white space."""
    return None if has_odd_space(text) else _UNIT.findall(text)


def has_odd_space(text: str) -> bool:
    """Whether a text holds white space but space and line end. One search a character: far quicker than a pattern."""
    return any(c in text for c in (_ODD_ASCII if text.isascii() else _ODD_ONES))


@functools.lru_cache(maxsize=1)
def split_pattern():
    """The pattern that byte-level BPEs split a text with: contractions, and runs of letters, numbers or other characters with a space before them."""
    import public_tokenizers
    import regex
    return regex.compile(public_tokenizers.PATTERN)


def pretokens(tokenizer, text: str, usual: bool) -> list[str]:
    """The parts that the tokenizer's pre-tokenizer cuts a text into. ``usual``: it splits by the usual pattern, which is applied here where all agree on it."""
    if usual and not _UNSURE.search(text):
        return [text] if text[:1] == " " and text[1:].isalpha() else split_pattern().findall(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level spelling stands for: printable Latin-1 characters stand for
    themselves, the other bytes are numbered from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=1)
def _spelling() -> dict[int, str]:
    return {b: c for c, b in byte_alphabet().items()}


def spelled(text: str) -> str:
    """The byte-level spelling of a text: the character of each of its UTF-8 bytes (of printable ASCII only the space differs)."""
    if text.isascii() and text.isprintable():
        return text.replace(" ", "\u0120")
    return text.encode().decode("latin-1").translate(_spelling())


@functools.lru_cache(maxsize=4)
def byte_bpe_entries(name: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE; a special token's are its string in UTF-8."""
    t, alphabet = byte_bpe(name, True), byte_alphabet()
    special = {i: a.content.encode() for i, a in t.get_added_tokens_decoder().items()}
    spelled = {i: s for s, i in t.get_vocab(with_added_tokens=True).items()}
    return [special[i] if i in special else bytes(alphabet[c] for c in spelled.get(i, "")) for i in range(max(spelled) + 1)]


@functools.lru_cache(maxsize=4)
def sentence_pieces(name: str) -> list[bytes]:
    """The bytes of every id of a sentencepiece model: U+2581 is a space, <0xHH> the byte HH."""
    p = sentences(name)
    return [bytes([int(s[3:5], 16)]) if p.is_byte(i) else s.replace("\u2581", " ").encode() for i in range(p.get_piece_size()) for s in (p.id_to_piece(i),)]
