"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable

# fixed values: the pattern that byte-level BPE vocabularies of this kind split texts by
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: a space that has other white space or the end of the text beside it
ODD_SPACE = re.compile(r"\s | \s| \Z")
CACHE = 300_000


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such a file: printable ones for themselves, the
    others for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


def _ranks(path: str) -> dict[bytes, int] | None:
    """Vocabulary by bytes, if its ids are in the order of its merges; else None."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, splits = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or splits.get("type") != "ByteLevel" or spec.get("normalizer"):
        return None
    if splits.get("add_prefix_space") or not splits.get("use_regex", True):
        return None
    letters = _byte_letters()
    special = {token["content"] for token in spec.get("added_tokens", [])}
    vocab = {word: i for word, i in model["vocab"].items() if word not in special}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    ids = [vocab.get(m.replace(" ", "", 1)) for m in merged]
    if ids != list(range(256, 256 + len(ids))) or len(vocab) != 256 + len(ids):
        return None
    return {bytes(letters[c] for c in word): i for word, i in vocab.items()}


def _added(path: str) -> dict[str, int] | None:
    """Added tokens that are found as they stand in a text; None if some need other rules."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        return None
    return {t["content"]: t["id"] for t in added}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level file; an added token's are its UTF-8."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = _byte_letters()
    out = {i: bytes(letters[c] for c in word if c in letters) for word, i in spec["model"]["vocab"].items()}
    out.update({t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])})
    return [out.get(i, b"") for i in range(max(out) + 1)]


def kept(make: Callable, *arguments):
    """``make(*arguments)``, made once in a Python worker and kept over its tasks.

    Functions travel to workers by value, with globals of their own; the interpreter's last."""
    objects = vars(sys).setdefault("_gridtide_kept", {})
    name = (make.__module__, make.__qualname__, *arguments)
    if name not in objects:
        objects[name] = make(*arguments)
    return objects[name]


def encoder(path: str, plain: bool = True, cache: int = CACHE) -> Callable[[str], bytes]:
    """Text to its ids as little-endian unsigned 32-bit numbers. ``plain``: the strings of
    special tokens in a text are ordinary text; else they are those tokens.

    The ids are those of the file in ``tokenizers``. Where the file's ids follow its merges,
    ``tiktoken`` computes the same ones faster. A text is split at single spaces, which always
    begin a new part, so that frequent words are encoded once; up to ``cache`` of them are kept,
    and with 0 texts are encoded as they are.
    """
    ranks, added = _ranks(path), _added(path)
    if ranks is None or (added is None and not plain):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = plain
        return lambda text: array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    import tiktoken

    encode = tiktoken.Encoding(
        "own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary
    known: dict[str, bytes] = {}

    def run(text: str) -> bytes:
        if not cache or ODD_SPACE.search(text):
            return array("I", encode(text)).tobytes()
        if len(known) > cache:
            known.clear()
        head, *rest = text.split(" ")
        out = [array("I", encode(head)).tobytes()]
        for word in rest:
            ids = known.get(word)
            if ids is None:
                ids = known[word] = array("I", encode(" " + word)).tobytes()
            out.append(ids)
        return b"".join(out)

    if plain or not added:
        return run
    found = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    single = {content: array("I", [i]).tobytes() for content, i in added.items()}

    def run_special(text: str) -> bytes:
        if not found.search(text):
            return run(text)
        parts = found.split(text)
        return b"".join(single[x] if x in single else run(x) for x in parts if x)

    return run_special
