"""Problem 4: one consistent form for texts that look the same.

``plain`` settles width, compatibility and composed forms, invisible characters, white space and dashes. Look-alike letters of
other scripts are then repaired by token. In a token of alphabets the script most of its unambiguous letters have is its own. In a
stretch of katakana and kanji a look-alike takes the script before it, the one after it, or katakana throughout. Look-alikes are
replaced if all one-script stretches of the result occur in the corpus; of several results the one with the fewest stretches, then
the most frequent ones, is taken. A token of a single alphabet stays; ``skeleton`` stands for what can be seen: it has one letter
for each shape.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsumugi.llm.common import only, stage

# Letters of the same shape, by script (Latin, Greek, Cyrillic; katakana, kanji, hiragana).
LATIN_GREEK = dict(zip("ABEHIKMNOPTXYZovyx", "ΑΒΕΗΙΚΜΝΟΡΤΧΥΖονγχ"))
LATIN_CYRILLIC = dict(zip("ABCEHIJKMOPSTXYacehijopsxydlqw", "АВСЕНІЈКМОРЅТХҮасеһіјорѕхуԁӏԛԝ"))
KATAKANA_KANJI = dict(zip("エオカタトニハヒムメロノー", "工才力夕卜二八匕厶乂口丿一"))
KATAKANA_HIRAGANA = dict(zip("ヘベペリ", "へべぺり"))
GREEK_SMALL_KEPT = frozenset("γ")
DASHES = "‐‑‒–—―−﹘﹣－⁃˗⸺⸻"
LINE_DRAWING_DASH = "─"


@lru_cache(1)
def invisible() -> str:
    """Characters that show nothing: format characters, controls but white space, variation selectors and fillers."""
    kept = {"\t", "\n", "\v", "\f", "\r", "\x1c", "\x1d", "\x1e", "\x1f", "\x85"}
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Cf", "Cc") and c not in kept or 0xFE00 <= ord(c) <= 0xFE0F or 0xE0100 <= ord(c) <= 0xE01EF or c in "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ⁥")


@lru_cache(1)
def tables() -> tuple[dict, dict, dict]:
    """For ``str.translate``: to plain, to the skeleton; and the scripts' letters of each shape."""
    plain = {ord(c): None for c in invisible()} | {ord(c): "-" for c in DASHES + LINE_DRAWING_DASH}
    shape: dict[str, str] = {}
    for pairs in (LATIN_GREEK, LATIN_CYRILLIC, KATAKANA_KANJI, KATAKANA_HIRAGANA):
        for own, other in pairs.items():
            if other not in GREEK_SMALL_KEPT:
                shape[other] = own
    # the shape of ハ and 八, ニ and 二 and so on is that of the katakana; the long mark looks like a dash
    skeleton = {ord(other): own for other, own in shape.items()} | {ord("ー"): "-", ord("一"): "-"}
    letters: dict[str, dict[str, str]] = {}
    for other, own in [*shape.items(), *((own, own) for own in set(shape.values()))]:
        letters.setdefault(own, {})[script(other)] = other
    return plain, skeleton, letters


@lru_cache(4096)
def script(c: str) -> str:
    """Latin, Greek, Cyrillic, Katakana, Hiragana, Han or an empty string."""
    if c in "ー":
        return "Katakana"
    word = unicodedata.name(c, "").split(" ")[0].split("-")[0]
    return {"LATIN": "Latin", "GREEK": "Greek", "CYRILLIC": "Cyrillic", "KATAKANA": "Katakana", "HIRAGANA": "Hiragana", "CJK": "Han"}.get(word, "")


def plain(text: str) -> str:
    """Width, composition, invisible characters, white space and dashes in one form; case and letters stay."""
    if text.isascii() and "  " not in text and text.isprintable():
        return text.strip()
    table = tables()[0]
    once = unicodedata.normalize("NFKC", text.translate(table))
    # composing may bring up white space and dashes
    return " ".join(unicodedata.normalize("NFC", once.translate(table)).split())


def skeleton(text: str) -> str:
    """One letter for each shape; equal for texts that look the same."""
    return text.translate(tables()[1])


#: Tokens in which look-alikes are repaired: letters of the alphabets, or a stretch of katakana, kanji and kana of katakana's shapes.
TOKEN = re.compile("[A-Za-zÀ-ɏͰ-ϿЀ-ԯ]+|[ァ-ヺー一-鿿へべぺり]+")
ALPHABETS = ("Latin", "Greek", "Cyrillic")
HIRAGANA = re.compile("[ぁ-ゖ]")


def tokens(text: str) -> Iterator[tuple[str, bool, bool]]:
    """Tokens of ``text``, and whether hiragana stand before and after them."""
    for m in TOKEN.finditer(text):
        yield around(m)


def around(m: re.Match) -> tuple[str, bool, bool]:
    text, a, b = m.string, m.start(), m.end()
    return m[0], a > 0 and "ぁ" <= text[a - 1] <= "ゖ", b < len(text) and "ぁ" <= text[b] <= "ゖ"


@lru_cache(1 << 17)
def repairs(token: str, before: bool = False, after: bool = False) -> tuple[str, ...]:
    """What ``token`` may be with its look-alikes in other scripts, itself included where it is one of these; empty if it may only be itself."""
    _, table, letters = tables()
    shapes = [table.get(ord(c), c) if script(c) in ALPHABETS or ord(c) in table else c for c in token]
    shapes = ["ー" if c in "ー一" else s for c, s in zip(token, shapes)]
    if not any(s in letters for s in shapes):
        return ()
    scripts = [script(c) for c in token]
    if scripts[0] in ALPHABETS:
        if len(set(scripts)) == 1:
            return ()
        clear = [s for s, shape in zip(scripts, shapes) if shape not in letters]
        dominant = max(ALPHABETS, key=lambda s: (clear.count(s), scripts.count(s), s == "Latin"))
        made = "".join(letters[shape].get(dominant, c) if shape in letters else c for c, shape in zip(token, shapes))
        return (made,) if made != token and {script(c) for c in made} == {dominant} else ()
    sides = []
    for order, outer in ((range(len(token)), before), (range(len(token) - 1, -1, -1), after)):
        near, made = "Hiragana" if outer else "", list(token)
        for i in order:
            if shapes[i] not in letters:
                near = scripts[i]
            else:
                made[i] = letters[shapes[i]].get(near, made[i])
        sides.append("".join(made))
    kana = "".join(letters[s].get("Katakana", c) if s in letters else c for c, s in zip(token, shapes))
    made = {*sides, *([kana] if any(s == "Katakana" and shape not in letters for s, shape in zip(scripts, shapes)) or len(set(scripts)) > 1 else [])}
    return tuple(sorted(made)) if made != {token} else ()


@lru_cache(1 << 17)
def parts(made: str) -> tuple[str, ...]:
    """The one-script stretches of a token, by which it is looked up."""
    out: list[str] = []
    for c in made:
        if out and script(out[-1][-1]) == script(c):
            out[-1] += c
        else:
            out.append(c)
    return tuple(out)


def chosen(forms: tuple[str, ...], known: dict[str, int]) -> str | None:
    """The form whose stretches all occur: that with the fewest, then the most frequent ones; none if no form's do."""
    found = [f for f in forms if all(p in known for p in parts(f))]
    return min(found, key=lambda f: (len(parts(f)), -min(known[p] for p in parts(f)), f)) if found else None


def unify(df: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    """``id, field, stored, unified, look, open``: each value of ``text_cols`` in one consistent form.

    ``unified`` is the form to store; ``look`` its skeleton, equal for values that look the same; ``open`` tells that it has a token
    of which the corpus has no form, or one of foreign letters only that all look like others: it is as it was. Null and blank
    values give no row; repeated rows give one; other columns are ignored.
    """
    source = only(df, id=id_col, **{f"t{i}": c for i, c in enumerate(text_cols)})
    long = source.select("id", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"t{i}").alias("stored")) for i, c in enumerate(text_cols)])).alias("x")).select("id", "x.field", "x.stored").where("stored is not null").distinct()

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [plain(text) for text in batch.column(2).to_pylist()]
            wanted = [sorted({p for token in set(tokens(base)) for form in repairs(*token) for p in parts(form)}) for base in made]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made), pa.array(wanted, pa.list_(pa.string()))], names=["id", "field", "stored", "base", "wanted"])

    def vocabulary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(p for text in batch.column(0).to_pylist() for p in {p for w in set(TOKEN.findall(text)) for p in parts(w)})
            yield pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], names=["word", "n"])

    kind = source.schema["id"].dataType.simpleString()
    # written once, as three plans read it
    based = stage(long.mapInArrow(first, f"id {kind}, field string, stored string, base string, wanted array<string>").where("base <> ''").withColumn("h", F.xxhash64("field", "stored")), "plain_texts")
    words = based.select("base").mapInArrow(vocabulary, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    asked = based.select("id", "h", F.explode("wanted").alias("word"))
    known = asked.join(words, "word").groupBy("id", "h").agg(F.collect_list(F.struct("word", "n")).alias("known"))  # bounded by one text
    joined = based.join(known, ["id", "h"], "left").select("id", "field", "stored", "base", "known")

    def last(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, left = [], []
            for base, known in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                text, undecided = repaired(base, {w["word"]: w["n"] for w in known or ()})
                made.append(text)
                left.append(undecided)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.string()), pa.array([skeleton(t) for t in made], pa.string()), pa.array(left, pa.bool_())], names=["id", "field", "stored", "unified", "look", "open"])

    return joined.mapInArrow(last, f"id {kind}, field string, stored string, unified string, look string, open boolean")


def repaired(base: str, known: dict[str, int]) -> tuple[str, bool]:
    """``base`` with its tokens in the forms the corpus knows, and whether any could not be decided."""
    undecided = False

    def repair(m: re.Match) -> str:
        nonlocal undecided
        if forms := repairs(*around(m)):
            form = chosen(forms, known)
            undecided |= form is None
            return form or m[0]
        undecided |= foreign(m[0])
        return m[0]

    return TOKEN.sub(repair, base), undecided


@lru_cache(1 << 17)
def foreign(token: str) -> bool:
    """Whether all letters are of another alphabet and look like Latin ones."""
    return script(token[0]) in ("Greek", "Cyrillic") and all(ord(c) in tables()[1] for c in token)


def settle(unified: DataFrame) -> DataFrame:
    """``unified`` with one form for each look: where repairs left several, the most frequent one, of these the least."""
    keyed = unified.withColumn("k", F.xxhash64("look")).withColumn("h", F.md5("look"))
    varied = keyed.select("k", "h", F.md5("unified").alias("form")).groupBy("k", "h").agg(F.min("form").alias("least"), F.max("form").alias("most")).where("least < most").select("k", "h")
    votes = keyed.join(varied, ["k", "h"], "left_semi").groupBy("k", "h", "unified").agg(F.count("*").alias("n"))
    top = votes.groupBy("k", "h").agg(F.min(F.struct((-F.col("n")).alias("n"), "unified")).alias("best")).select("k", "h", F.col("best.unified").alias("chosen"))
    return keyed.join(top, ["k", "h"], "left").select("id", "field", "stored", F.coalesce("chosen", "unified").alias("unified"), "look")


def same_looking_pairs(unified: DataFrame) -> DataFrame:
    """``field, row_id_a, row_id_b, by``: pairs of ids whose values look the same but differ as stored.

    ``by`` is ``repair`` where their unified forms are equal. Where the corpus could not decide a token of one of them (``open``),
    their looks are compared: ``shape``. Forms of a single stored value are left out before rows meet.
    """
    keyed = stage(unified.select("field", "id", F.md5("unified").alias("form"), F.md5("look").alias("look"), F.md5("stored").alias("stored"), "open"), "forms")

    def paired(rows: DataFrame, by: str) -> DataFrame:
        varied = rows.groupBy("field", by).agg(F.min("stored").alias("least"), F.max("stored").alias("most")).where("least < most").select("field", by)
        rows = rows.join(varied, ["field", by], "left_semi")
        other = rows.select("field", by, *[F.col(c).alias(f"{c}_b") for c in ("id", "stored", "form", "look", "open") if c != by])
        return rows.join(other, ["field", by]).where("id < id_b and stored <> stored_b")

    some = keyed.where("open").select("field", "look").distinct()
    by_shape = paired(keyed.join(some, ["field", "look"], "left_semi"), "look").where("form <> form_b and (open or open_b)")
    pairs = [rows.select("field", F.col("id").alias("row_id_a"), F.col("id_b").alias("row_id_b"), F.lit(name).alias("by")) for rows, name in ((paired(keyed, "form"), "repair"), (by_shape, "shape"))]
    return pairs[0].unionByName(pairs[1]).groupBy("field", "row_id_a", "row_id_b").agg(F.min("by").alias("by"))
