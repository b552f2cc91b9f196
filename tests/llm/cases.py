"""Small tables with the awkward rows that every operator must take."""

import re

LONG = " ".join(f"word{i % 997} und{i % 13}" for i in range(20_000))

# doc_id, text, lang, source
AWKWARD = [
    (0, None, "en", "a"),
    (1, "", "en", "a"),
    (2, " \n\t ", None, None),
    (3, "A Bc", "en", "b"),
    (4, "a bC", "en", "b"),
    (5, "one two three four five six", "en", None),
    (6, "one two three four five six", "de", "a"),
    (6, "one two three four five six", "de", "a"),
    (7, LONG, "de", "a"),
    (8, "É é ß ΣΑΣ İ", None, "c"),
    (None, "no id here", "en", "c"),
    (None, None, None, None),
    (9, "a <|endoftext|> b<|startoftext|>c's 12 　 日本語 ½ \x85 x", "en", "c"),
    (9, "same id, other text under the MIT License", "en", "c"),
    (10, "GNU General Public-License, CC  BY cc by", "en", "b"),
]

# Names that operators use themselves.
CLASHING = (
    "id content digest key words n v root size draws pass shard rank block place score spans lang_pred "
    "part at ids start length keep_id group_size target source_size vec query of order row doc gone "
    "script form output restored steps n_a a_ids row_key id_of_row id_that_goes "
    "__id __row __of_row __digest"
).split()

_SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def documents(spark, rows=AWKWARD, clashing=True):
    df = spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], _SCHEMA)
    return df.selectExpr("*", *[f"'{x}' AS `{x}`" for x in CLASHING]) if clashing else df


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
