"""Small tables for the tests of the language-model operators."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

DOCUMENT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
LABEL = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
EMBEDDING = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
TURN = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
SF = "/root/testdata/sf0.001"

#: Names that operators use inside, as columns a caller might have too.
CLASHES = ["row", "size", "hash", "copies", "score", "n", "x", "ids", "part", "rule", "set_id", "text_", "words_", "bucket", "source_key", "lang_pred", "readable_", "integers", "cluster", "distance", "packed", "whitened", "deviation", "value_of_text", "digest_1_", "value"]


def write(folder: Path, clash: bool = False, **tables: list) -> str:
    """Write tables of rows (tuples in schema order) as the files a query reads."""
    schemas = {"documents": DOCUMENT, "labels": LABEL, "pages": PAGE, "conversations": TURN, "embeddings": EMBEDDING}
    for name, rows in tables.items():
        schema = schemas[name]
        got = pa.Table.from_pydict({f: [r[i] for r in rows] for i, f in enumerate(schema.names)}, schema)
        if clash:
            for c in CLASHES:
                got = got.append_column(c, pa.array([f"{c}!"] * len(rows), pa.string()))
        pq.write_table(got, folder / f"{name}.parquet")
    return str(folder)


def read(folder: str, name: str) -> list[dict]:
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def rows_of(df) -> list[dict]:
    return df.toArrow().to_pylist()


LETTERS = {"en": "the of and to in is that ing tion er", "de": "der die und ein sch ung keit zu ich ver", "fr": "le la et que eau ment é è une ai"}


def text(rng: random.Random, n: int, lang: str = "en") -> str:
    parts = LETTERS[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def awkward(rng: random.Random, n: int = 60) -> list[tuple]:
    """Documents with nulls, blanks, repeats, a hot source and a very long text."""
    docs = []
    for i in range(n):
        lang = rng.choice(list(LETTERS))
        lines = "\n".join(text(rng, rng.randint(3, 30), lang) for _ in range(rng.randint(1, 5)))
        docs.append((i, lines, lang, "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", None]), None))
    docs += [(n, None, None, "a", None), (n + 1, "", "en", None, 0), (n + 2, " \t\n\x0b ", "en", "b", 5), (n + 3, "one", "en", "b", 3)]
    docs += [(n + 4, docs[0][1], "en", "a", 9), (n + 4, docs[0][1], "en", "a", 9), (n + 5, text(rng, 30_000), "en", "zz", None)]
    docs += [(n + 6, "tab\tand\x0bother\x0cgaps  here\r\nline two\r\nline two", "en", "b", None), (n + 7, "😀 emoji ñ İı ſ ǅ ￼ <|endoftext|> it's 12345 don't ÀÉ", "fr", "c", None)]
    return docs
