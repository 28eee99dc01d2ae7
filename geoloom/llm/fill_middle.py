"""Fill-in-middle: documents cut into prefix, middle and suffix, and put together in another order.

The tokenizers library's Split pre-tokenizer, with isolated matches of a pattern, gives each text's tokens as
code-point offsets; nothing is trained. The number of offsets is n; two hashes rank two of them, which are the cuts.
Long texts go through it in blocks that end where a token ends in any case, so that memory does not grow with the
text, unless one token is that long.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from .common import tidy, worker_cache

#: Fixed values.
MARKS = ("<P>", "<S>", "<M>")
TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: A token ends wherever white space follows other characters.
_END = re.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
#: Code points that a block has at least, if it is not the last.
BLOCK = 1 << 16
#: A batch that goes back to Spark is closed beyond so many code points.
BATCH_CHARS = 1 << 22
SCHEMA = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def blocks(text: str, least: int = BLOCK) -> Iterator[tuple[int, str]]:
    """(start, piece) of pieces that make up the text, each ending where a token ends."""
    start = 0
    while len(text) - start > least:
        end = _END.search(text, start + least - 1)
        if not end:
            break
        yield start, text[start : end.end()]
        start = end.end()
    if start < len(text):
        yield start, text[start:]


def offsets(split: Split, text: str) -> list[int]:
    """Where each token ends."""
    return [start + to for start, piece in blocks(text) for _, (_, to) in split.pre_tokenize_str(piece)]


def splitter() -> Split:
    """This Python worker's pre-tokenizer."""
    kept = worker_cache("fim")
    if "split" not in kept:
        kept["split"] = Split(Regex(TOKEN), "isolated")
    return kept["split"]


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers of 32 bits from a document's id; a null id counts as an empty one."""
    told = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(told[i : i + 8], 16) for i in (0, 8, 16, 24)]


def transform(split: Split, doc_id: object, text: str, rate: int, spm_rate: int, seed: int) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, code points of the prefix, of the middle, output)."""
    ends = [0, *offsets(split, text)]
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= rate or any(m in text for m in MARKS):
        return n, "plain", None, None, text
    a, b = (ends[i] for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if h4 % 100 < spm_rate:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 50, spm_rate: int = 80, seed: int = 42) -> DataFrame:
    """One row per row of docs: doc_id, n (tokens), form (plain, psm, spm), prefix_chars, middle_chars (null if plain), output.

    rate: of a hundred documents, so many are cut; spm_rate: of a hundred of these, so many have the suffix first.
    Both and the cuts depend on the id and the seed alone. Texts that contain a mark stay plain, as they could not be
    read back. Null and empty texts: n 0, plain, an empty output. Null ids count as empty ones; repeated rows give
    equal results. Other columns are not read. Texts stream through in Arrow batches; nothing is shuffled.
    """
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for batch in batches:
            ids, first, rows, size = batch.column(0), 0, [], 0
            for at, (doc_id, text) in enumerate(zip(ids.to_pylist(), batch.column(1), strict=True), 1):
                told = text.as_py() or ""
                rows.append(transform(split, doc_id, told, rate, spm_rate, seed))
                size += len(told)
                if size > BATCH_CHARS or at == len(ids):
                    yield _batch(ids.slice(first, at - first), rows)
                    first, rows, size = at, [], 0

    return source.mapInArrow(tidy("fim", run), f"doc_id {kind}, {SCHEMA}")


def _batch(ids: pa.Array, rows: list[tuple[int, str, int | None, int | None, str]]) -> pa.RecordBatch:
    n, form, prefix, middle, output = zip(*rows, strict=True)
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    made = [pa.array(x, k) for x, k in zip((n, form, prefix, middle, output), kinds, strict=True)]
    return pa.RecordBatch.from_arrays([ids, *made], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restore(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
