"""One form for text that looks the same but is stored in different characters.

Every Arrow batch of a partition goes through one embedded DuckDB statement:
compatibility forms and typographic spaces, hyphens and apostrophes become the
ordinary characters, invisible characters disappear, letters of other scripts
that look like Latin ones become Latin where the name is Latin, and
``nfc_normalize`` composes accents. No shuffle; work is per row.

Defined results
---------------
* Null stays null; an empty text stays empty; an empty table gives no rows.
* A text with letters of another script and no Latin letter is left as it is,
  unless every one of its letters looks like a Latin letter.
* Ordinary accented letters and repeated plain spaces stay as they are.
* Texts of any length are treated whole; equal texts get equal forms.
* ``with_canonical`` keeps all columns; its own two must be named so that they
  don't clash, which is checked.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that look like a Latin letter, with that letter.
CYRILLIC = "АВСЕНІЈКМОРЅТУХҮԚԜԌаԁеһіјӏорԛѕсухүѵԝ"
CYRILLIC_AS = "ABCEHIJKMOPSTYXYQWGadehijlopqscyxyvw"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαγηικνορυχϲϳ"
GREEK_AS = "ABEZHIKMNOPTYXaynikvopuxcj"
ARMENIAN = "ՕՍՏԼահոսօցզյ"
ARMENIAN_AS = "OUSLwhnuogqj"
LISU = "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"
LISU_AS = "BPDTGKJCZFMNLSRVHWXYAEIOU"
CHEROKEE = "ᎪᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ"
CHEROKEE_AS = "ACDEGHJKLMPRSTVWZ"
LATIN_ALIKE = "ɑɡ"
LATIN_ALIKE_AS = "ag"
#: Characters that look like a plain hyphen or apostrophe.
HYPHENS = "‐‑‒–−˗⁃﹘﹣"
APOSTROPHES = "‘’‛ʼʻʹˈ′ꞌꞋ´`"

LOOK_ALIKES = {
    a: b
    for letters, plain in (
        (CYRILLIC, CYRILLIC_AS), (GREEK, GREEK_AS), (ARMENIAN, ARMENIAN_AS), (LISU, LISU_AS),
        (CHEROKEE, CHEROKEE_AS), (LATIN_ALIKE, LATIN_ALIKE_AS),
    )
    for a, b in zip(letters, plain, strict=True)
}
#: Characters without width, as a regular expression class of DuckDB.
INVISIBLE = r"[\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{3164}\x{FFA0}\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}]"


@functools.cache
def compatibility_forms() -> tuple[dict[str, str], dict[str, str]]:
    """Single- and several-letter replacements, by rule from the Unicode database.

    A character counts if its compatibility form differs from its composed form
    and consists of Latin letters, digits, or ASCII punctuation and space.
    """
    one, many = {}, {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F1FF)):
        c = chr(code)
        if unicodedata.category(c) == "Zs" or c in "\u0085  ":
            one[c] = " "
            continue
        form = unicodedata.normalize("NFKC", c)
        if form == unicodedata.normalize("NFC", c) or unicodedata.combining(c):
            continue
        latin = all(ord(x) < 0x80 or "LATIN" in unicodedata.name(x, "") for x in form)
        if len(form) == 1 and latin:
            one[c] = form
        elif len(form) > 1 and latin and form.isalpha():
            many[c] = form
    one |= dict.fromkeys(HYPHENS, "-") | dict.fromkeys(APOSTROPHES, "'") | dict.fromkeys("\t\n\r\v\f", " ")
    return one, many


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _translated(column: str, table: dict[str, str]) -> str:
    return f"translate({column}, {_quoted(''.join(table))}, {_quoted(''.join(table.values()))})"


@functools.cache
def canonical_sql(source: str, column: str) -> str:
    """DuckDB statement that adds ``canonical`` and ``mixed`` (Latin beside letters of another script)."""
    one, many = compatibility_forms()
    spelled_out = "x"
    for c, form in many.items():
        spelled_out = f"replace({spelled_out}, {_quoted(c)}, {_quoted(form)})"
    any_of = "[" + "".join(many) + "]"
    other = r"[^\p{Latin}\P{L}]"  # a letter outside the Latin script
    return f"""
    WITH plain AS (
      SELECT *, {column} AS s, {column} IS NOT NULL AND regexp_matches({column}, '[^ -_a-~À-ÖØ-öø-ıĴ-ľŁ-ňŊ-ž]') AS odd
      FROM {source}),
    folded AS (
      SELECT * EXCLUDE (s), CASE WHEN odd THEN regexp_replace({_translated('s', one)}, '{INVISIBLE}', '', 'g') ELSE s END AS x
      FROM plain),
    spelled AS (
      SELECT * EXCLUDE (x), CASE WHEN odd AND regexp_matches(x, {_quoted(any_of)}) THEN {spelled_out} ELSE x END AS x
      FROM folded),
    latin AS (
      SELECT *, CASE WHEN odd THEN {_translated('x', LOOK_ALIKES)} ELSE x END AS t FROM spelled),
    judged AS (
      SELECT *, odd AND regexp_matches(t, '{other}') AS foreign_left, odd AND regexp_matches(x, '\\p{{Latin}}') AS has_latin
      FROM latin)
    SELECT * EXCLUDE (odd, x, t, foreign_left, has_latin),
      CASE WHEN NOT odd THEN x WHEN foreign_left AND NOT has_latin THEN {column} ELSE nfc_normalize(t) END AS canonical,
      coalesce(foreign_left AND has_latin, false) AS mixed
    FROM judged
    """


def canonicalizer(statement: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function that runs ``statement`` over the Arrow batches of a partition; the text is in ``name``."""

    def canonicalize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        connection = duckdb.connect(config={"threads": 1})
        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                names = pa.table({"i": pa.array(range(batch.num_rows), pa.int64()), "name": batch.column("name")})
                connection.register("batch", names)
                found = connection.sql(statement).to_arrow_table()
                connection.unregister("batch")
                # only the text went through the statement: every other column is passed on as it came
                for column, kind in (("canonical", pa.string()), ("mixed", pa.bool_())):
                    batch = batch.append_column(column, pa.concat_arrays([c.cast(kind) for c in found[column].chunks]))
                yield batch
        finally:
            connection.close()

    return canonicalize


def with_canonical(df: DataFrame, column: str, canonical: str = "canonical", mixed: str = "mixed_script") -> DataFrame:
    """All columns of ``df``, the canonical form of ``column`` and whether letters of two scripts remain in it."""
    if {canonical, mixed} & set(df.columns):
        raise ValueError(f"{canonical} or {mixed} is a column already")
    # positions, not names, go through Arrow: any name is then safe in the statement
    aliases = [f"c{i}" for i in range(len(df.columns))]
    inner = df.toDF(*aliases).withColumn("name", F.col(aliases[df.columns.index(column)]))
    schema = T.StructType([*inner.schema.fields, T.StructField("canonical", T.StringType()), T.StructField("mixed", T.BooleanType())])
    statement = f"SELECT canonical, mixed FROM ({canonical_sql('batch', 'name')}) ORDER BY i"
    out = inner.mapInArrow(canonicalizer(statement), schema)
    return out.select(*[F.col(a).alias(c) for a, c in zip(aliases, df.columns, strict=True)], F.col("canonical").alias(canonical), F.col("mixed").alias(mixed))
