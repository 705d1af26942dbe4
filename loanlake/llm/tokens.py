"""Token ids of whole texts by a byte-level BPE tokenizer, a batch at a time.

Such a tokenizer never joins text across a space that follows a non-space
character, so a text may be cut before any such space: the ids of the parts
together are the ids of the text. Long texts are cut there, and so are texts that
are Latin in part.

Runs of Latin pieces are encoded from the same vocabulary in its other form, as
ranks, which gives the same ids in a third of the time; all other pieces go to the
tokenizer itself. Nothing is remembered from one batch to the next, so a worker
holds one batch, whatever it meets.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa

SAFE_CUT = re.compile(r"(?<=\S)(?= )")
UNSAFE_SPACE = re.compile(r"\s ")
#: Characters of text encoded at a time, which cost a worker many times their size, and of
#: the longest part of a text.
BATCH_CHARS = 1 << 17
PART_CHARS = 1 << 18
#: Pieces without these are encoded by ranks; both libraries agree on smaller code points.
OTHER = re.compile("[\u0250-\U0010ffff]|<\\|")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Path of an installed tokenizer file, on the machine that calls it."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def load_ranks(path: str):
    """The vocabulary as ranks that lies beside the tokenizer file, or None."""
    file = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(file):
        return None
    import public_tokenizers
    import tiktoken

    with open(file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        os.path.basename(file),
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={},
    )


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Cut ``text`` at safe boundaries into parts of about ``size`` characters.

    A part is longer only where no safe boundary is nearer.
    """
    start = 0
    while len(text) - start > size:
        cut = text.rfind(" ", start + 1, start + size)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.rfind(" ", start + 1, cut)
        if cut <= 0:
            later = SAFE_CUT.search(text, start + size)
            if later is None:
                break
            cut = later.start()
        yield text[start:cut]
        start = cut
    yield text[start:]


def pieces(text: str) -> tuple[str, list[str]]:
    """First part of ``text`` up to a safe cut, and the others without their leading space."""
    if UNSAFE_SPACE.search(text) is None:
        rest = text.split(" ")
        return rest.pop(0), rest
    first, *rest = SAFE_CUT.split(text)
    return first, [piece[1:] for piece in rest]


def latin_runs(text: str) -> list[tuple[bool, str]]:
    """The text in runs of pieces that ranks may encode and pieces that they may not."""
    first, rest = pieces(text)
    runs: list[tuple[bool, list[str]]] = []
    for at, piece in enumerate([first, *rest]):
        latin = OTHER.search(piece) is None
        if not runs or runs[-1][0] != latin:
            runs.append((latin, []))
        runs[-1][1].append(piece if at == 0 else " " + piece)
    return [(latin, "".join(run)) for latin, run in runs]


class Encoder:
    """Encodes texts in batches of equal size; keeps nothing of one batch for the next."""

    def __init__(self, path: str, keep: Callable[[list[int]], Any]):
        self.tokenizer, self.ranks, self.keep = load(path), load_ranks(path), keep

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[int, list[Any]]]:
        """``(number of the text, what is kept of its ids)``, in order.

        A long text gives several pairs, one for each of its parts.
        """
        batch: list[tuple[int, str]] = []
        size = 0
        for number, text in enumerate(texts):
            for part in parts(text):
                batch.append((number, part))
                size += len(part)
                if size >= BATCH_CHARS:
                    yield from self.flush(batch)
                    batch, size = [], 0
        yield from self.flush(batch)

    def flush(self, batch: list[tuple[int, str]]) -> Iterator[tuple[int, list[Any]]]:
        runs: list[tuple[int, bool, str]] = []
        for at, (_, part) in enumerate(batch):
            # A part without a safe cut is one piece, and goes to the tokenizer if it is long.
            if self.ranks is None or len(part) > 2 * PART_CHARS:
                runs.append((at, False, part))
            elif OTHER.search(part) is None:
                runs.append((at, True, part))
            else:
                runs.extend((at, *run) for run in latin_runs(part))
        ranked, others = ([run for _, latin, run in runs if latin is kind] for kind in (True, False))
        by_rank = iter(self.ranks.encode_ordinary_batch(ranked, num_threads=1) if ranked else ())
        encoded = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        kept: list[list[Any]] = [[] for _ in batch]
        for at, latin, _ in runs:
            kept[at].append(self.keep(next(by_rank) if latin else next(encoded).ids))
        for (number, _), found in zip(batch, kept, strict=True):
            yield number, found


@lru_cache(maxsize=4)
def encoder(path: str, keep: Callable[[list[int]], Any]) -> Encoder:
    """The encoder of this worker process, which loads its vocabulary once."""
    return Encoder(path, keep)


def text_list(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, with nulls as empty texts."""
    return [text or "" for text in column.to_pylist()]
