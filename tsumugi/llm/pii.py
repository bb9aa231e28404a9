"""Problem 3: personal information in free text, replaced by typed placeholders.

Detection works on a normalised copy whose characters map back to the source: transducers fold width, look-alike letters, dashes
and white space, drop invisible characters, compose voiced kana, and write spelled digits and "at"/"dot" disguises in plain.
A span found in the copy is cut out of the source where its first and last characters came from.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tsumugi.llm.common import only
from tsumugi.llm.text import DASHES, LATIN_CYRILLIC, LATIN_GREEK, invisible

KINDS = ("email", "phone", "id_number", "address", "name")
PLACEHOLDER = "[{}]"

# Digits as they are spelled, longest first.
SPELLED = {"ゼロ": "0", "マル": "0", "レイ": "0", "イチ": "1", "サン": "3", "ヨン": "4", "ロク": "6", "ナナ": "7", "シチ": "7", "ハチ": "8", "キュウ": "9", "キュー": "9", "ニ": "2", "ニー": "2", "ゴ": "5", "ゴー": "5", "ヨ": "4", "ク": "9"}
KANJI_DIGITS = dict(zip("〇零一二三四五六七八九", "00123456789"))


LONG_MARK = re.compile("(?<=[0-9])ー(?=[0-9])")


@lru_cache(1)
def folds() -> dict[int, str]:
    """Replacements of one character by one."""
    table = {0xFF01 + k: chr(0x21 + k) for k in range(94) if chr(0x21 + k) not in "%,"} | {0x3000: " ", 0xA0: " ", 0x202F: " ", 0x2007: " ", **{c: " " for c in range(0x2000, 0x200B)}}
    table |= {ord(c): "-" for c in DASHES + "─"} | {ord(other): own for pairs in (LATIN_CYRILLIC, LATIN_GREEK) for own, other in pairs.items()}
    return table | {ord(c): str(unicodedata.digit(c)) for c in map(chr, range(0x2460, 0x2469))}


@lru_cache(1)
def _folding() -> re.Pattern:
    return re.compile("[" + "".join(re.escape(chr(c)) for c in folds()) + "]")


def folded(text: str) -> str:
    """``text`` with one character for one; most texts have few to replace. A long mark between digits is a dash."""
    return LONG_MARK.sub("-", _folding().sub(lambda m: folds()[ord(m[0])], text))


@lru_cache(1)
def _simple() -> re.Pattern:
    """Matches texts that map one to one."""
    hidden = "".join(re.escape(c) for c in invisible() if c != "\x7f" and ord(c) < 0x10000)
    return re.compile(rf"[^{hidden}\U000E0000-\U000E01EFｦ-ﾟ⼀-⿕゙゚]*\Z")


#: Signs of disguises and spelled digits.
DISGUISE = re.compile("アット|あっと|ドット| at | dot |[\\[({（［【<＜]\\s?(?:at|AT|ａｔ|dot|DOT)|[〇零一二三四五六七八九ー・（）()-]{9}|(?:ゼロ|マル|レイ|サン|ヨン|ロク|ナナ|ハチ|キュウ|イチ|ニー?|ゴー?)(?:[・ 、-]?(?:ゼロ|マル|レイ|サン|ヨン|ロク|ナナ|ハチ|キュウ|イチ|ニー?|ゴー?)){3}")


@lru_cache(1)
def _unequal() -> re.Pattern:
    """What doesn't map one to one: invisible characters, voicing marks, half-width kana, radicals, disguises and spelled digits."""
    hidden = "".join(re.escape(c) for c in invisible() if c != "\x7f" and ord(c) < 0x10000)
    spelled = "|".join(sorted(SPELLED, key=len, reverse=True))
    return re.compile(
        rf"(?P<hidden>[{hidden}\U000E0000-\U000E01EF]+)|(?P<compose>[ｦ-ﾟ][ﾞﾟ]?|[⼀-⿕]|[ぁ-ヿ][゙゚])"
        r"|(?P<at>\s?[\[({（［【<＜]\s?(?:at|AT|アット|アットマーク|ａｔ)\s?[\])}）］】>＞]\s?|(?<=[A-Za-z0-9]) ?あっと ?(?=[A-Za-z])|(?<=[\w])(?:アットマーク|アット)(?=[A-Za-z])|(?<=[a-z0-9]) at (?=[a-z0-9-]+(?:\.| dot |\[dot\])))"
        r"|(?P<com>(?<=[A-Za-z0-9]) ?ドットコム)"
        r"|(?P<dot>\s?[\[({（［【]\s?(?:dot|DOT|ドット)\s?[\])}）］】]\s?|(?<=[A-Za-z0-9])ドット(?=[A-Za-z])|(?<=[a-z0-9]) dot (?=[a-z]))"
        rf"|(?P<spelled>(?:(?:{spelled})[・ 、-]?){{7,}})|(?P<kanji>[〇零一二三四五六七八九](?:[〇零一二三四五六七八九]|[-‐―－ー・（）()](?=[〇零一二三四五六七八九])){{8,}})"
    )


def normalise(text: str) -> tuple[str, list[int] | None, list[int] | None]:
    """The copy to search, and where each of its characters begins and ends in ``text`` (None: the same place)."""
    if _simple().match(text) and not DISGUISE.search(text):
        return folded(text), None, None
    pieces, begin, end, at = [], [], [], 0
    for m in _unequal().finditer(text):
        a, b, kind = m.start(), m.end(), m.lastgroup
        pieces.append(text[at:a])
        begin.extend(range(at, a))
        end.extend(range(at + 1, a + 1))
        if kind == "spelled":
            for part in re.finditer("|".join(sorted(SPELLED, key=len, reverse=True)) + "|.", m[0]):
                pieces.append(SPELLED.get(part[0], "-"))
                begin.append(a + part.start())
                end.append(a + part.end())
        elif kind == "kanji":
            pieces.append("".join(KANJI_DIGITS.get(c, "-" if c == "・" else c) for c in m[0]))
            begin.extend(range(a, b))
            end.extend(range(a + 1, b + 1))
        elif kind != "hidden":
            out = {"at": "@", "dot": ".", "com": ".com"}.get(kind) or unicodedata.normalize("NFKC", m[0])
            pieces.append(out)
            begin.extend([a] * len(out))
            end.extend([b] * len(out))
        at = b
    if not at:
        return folded(text), None, None
    pieces.append(text[at:])
    begin.extend(range(at, len(text)))
    end.extend(range(at + 1, len(text) + 1))
    return folded("".join(pieces)), begin, end


EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z0-9])")
PHONE = re.compile(r"(?<![0-9A-Za-z+-])(?:\+81[- ]?\(?0?\)?[1-9]\d{0,3}[- )]{0,2}\d{1,4}[- ]?\d{3,4}|\(0\d{1,4}\)[- ]?\d{1,4}[- ]?\d{4}|0\d{1,4}[- ]?\(\d{1,4}\)[- ]?\d{4}|0\d{1,4}([- .])\d{1,4}\1\d{4}|0\d{9,10})(?![0-9]|-[0-9])")
PHONE_NEAR = re.compile(r"(?:電話|TEL|Tel|tel|携帯|連絡先|FAX|ファクス|ファックス|番号は)[^0-9。]{0,6}$")
ID_NUMBER = re.compile(
    r"(?:個人番号|マイナンバー(?:カード)?(?:の?番号)?)[^0-9A-Za-z。\n]{0,6}(\d{4}[- ]?\d{4}[- ]?\d{4})(?!\d)"
    r"|(?:運転)?免許証?(?:の?番号)?[^0-9A-Za-z。\n]{0,6}(\d{12}|\d{2}[- ]\d{2}[- ]\d{6}[- ]\d{2}|\d{4}[- ]\d{4}[- ]\d{4})(?!\d)"
    r"|(?:旅券|パスポート)(?:の?番号)?[^0-9A-Za-z。\n]{0,6}([A-Z]{1,2}[- ]?\d{7,8})(?!\d)"
    r"|(?:基礎)?年金(?:手帳)?(?:の?番号)?[^0-9A-Za-z。\n]{0,6}(\d{4}[- ]?\d{6})(?!\d)"
    r"|(?:住民票コード)[^0-9A-Za-z。\n]{0,6}(\d{11}|\d{5}[- ]?\d{6})(?!\d)"
    r"|(?:在留カード)(?:の?番号)?[^0-9A-Za-z。\n]{0,6}([A-Z]{2}\d{8}[A-Z]{2})"
)
ID_HINT = re.compile("個人番号|マイナンバ|免許|旅券|パスポート|年金|住民票コード|在留カード")
NUMBER = r"(?:\d{1,4}|[〇一二三四五六七八九十百]{1,5})"
BUILDING = r"(?:[ ]?[一-龥ぁ-んァ-ヶーA-Za-z]{1,12}\d{1,4}(?:号室|号|階|F))?"
BLOCK = rf"(?:{NUMBER}丁目(?:{NUMBER}(?:番地?|[-の])?(?:{NUMBER}号?)?)?|{NUMBER}番地(?:[-の]?{NUMBER})?|{NUMBER}番{NUMBER}号|\d{{1,3}}-\d{{1,3}}(?:-\d{{1,4}})?(?![\d-]|[.,%]\d))"
ADDRESS = re.compile(
    rf"(?:〒\s?\d{{3}}-?\d{{4}}[ ]?)?(?:[一-龥]{{1,4}}[都道府県])?(?:[一-龥][一-龥ヶノぁ-ん]{{0,5}}[市区郡町村]){{1,4}}[一-龥ヶノケが々ぁ-んァ-ヴー]{{0,8}}?{BLOCK}{BUILDING}"
    r"|(?:\d{1,4}-){1,3}\d{1,4},? [A-Z][a-z]+(?:[- ][A-Za-z][a-z]+)*,? [A-Z][a-z]+-(?:shi|ku|cho|machi|mura|gun|ken)(?:, [A-Z][a-z]+(?:-[a-z]+)?)*"
)
K = "[一-龥々ヶノ]"
GLUED = rf"(?:{K}{{2,5}}[ぁ-ん]{{2,4}}|{K}{{2,8}})"
KANA = r"[ァ-ヶー]{2,8}[ ・][ァ-ヶー]{2,8}"
# Frequent family names.
FAMILY = "佐藤 鈴木 高橋 田中 伊藤 渡辺 山本 中村 小林 加藤 吉田 山田 佐々木 山口 松本 井上 木村 林 斎藤 清水 山崎 森 池田 橋本 阿部 石川 山下 中島 石井 小川 前田 岡田 長谷川 藤田 後藤 近藤 村上 遠藤 青木 坂本 斉藤 福田 太田 西村 藤井 岡本 金子 藤原 三浦 中野 中川 原田 松田 竹内 小野 田村 中山 和田 石田 森田 上田 原 内田 柴田 酒井 宮崎 横山 高木 安藤 宮本 大野 小島 谷口 工藤 今井 高田 増田 丸山 杉山 村田 大塚 新井 小山 平野 藤本 河野 上野 野口 武田 松井 千葉 菅原 岩崎 久保 木下 佐野 野村 松尾 菊地 市川 杉本 古川 大西 島田 水野 桜井 渡部 高野 吉川 山内 西田 飯田 菊池 西川 小松 北村 安田 五十嵐 川口 平田 関 中田 久保田 服部 東 岩田 土屋 川崎 福島 本田 樋口 永井 秋山 中西 大島"
FAMILY_NAME = rf"(?<!{K})(?:{'|'.join(sorted(FAMILY.split(), key=len, reverse=True))})"
GIVEN = rf"(?: (?:{K}{{1,3}}|[ぁ-ん]{{2,4}})|{K}{{1,3}})"
#: Titles after a name.
TITLES = ("課長", "部長", "係長", "室長", "次長", "主任", "先生", "教授", "弁護士", "選手", "容疑者", "被告", "君")
#: Words before さん and 様 that aren't names.
NO_NAMES = "担当者|担当|患者|業者|店員|職員|記者|学生|客|皆|皆々|運転手|社員|役員|議員|作業員|利用者|生産者|農家|母|父|兄|姉|娘|息子|奥|旦那|孫|医者|看護師|会員|各位|読者|得意|取引先|子|王|神|殿|奥"
#: What the text holds, and the name around it.
NAMES = [(hint, re.compile(p)) for hint, p in (
    ("氏名", rf"氏名[ ]?:[ ]?(?P<n>{K}{{1,6}}[ ](?:[ぁ-ん]{{2,4}}|{K}{{1,3}})|{GLUED})"),
    ("様", rf"(?P<n>{K}{{1,6}}[ ](?:{K}{{1,4}}|[ぁ-ん]{{2,5}})|{GLUED}|{KANA})(?<!多)(?<!同)(?<!仕)(?<!模)(?<!一)(?<!異)様(?![々子式相なにで])"),
    ("さん", rf"(?P<n>{K}{{1,6}}[ ](?:{K}{{1,4}}|[ぁ-ん]{{2,5}})|{K}{{2,8}}|{KANA})さん"),
    ("さん", r"(?:訴える|語る|話す|[はがの、。\s]|^)(?P<n>[ぁ-ん]{2,4})さん(?=\(\d)"),
    ("氏", rf"(?P<n>{K}{{1,6}}[ ](?:{K}{{1,4}}|[ぁ-ん]{{2,5}})|(?<=た)(?:{K}{{2,5}}[ぁ-ん]{{2,4}})|{K}{{2,8}}(?:[ぁ-ん]{{2,4}})?)氏(?!名|族|神)"),
    ("の", rf"(?:社長|会長|専務|常務|頭取|理事長|所長|工場長|取締役)の(?P<n>{K}{{2,5}}[ぁ-ん]{{2,4}}|{K}{{2,8}})(?=[はがも](?:記者|会見|取材|電話|書面))"),
    ("担当は", rf"担当は\S{{1,8}}?[課室部係]の(?P<n>{K}{{2,6}})です"),
    ("議長", rf"議長[ :]+(?P<n>{K}{{2,5}}[ぁ-ん]{{2,4}}|{K}{{2,8}})(?=、)"),
    ("書記", rf"書記[ :]+(?P<n>{K}{{2,5}}[ぁ-ん]{{2,4}}|{K}{{2,6}})"),
    ("文責", rf"文責[・: ]+(?P<n>{K}{{2,8}})(?=\))"),
    ("M", r"(?P<n>(?:Mr|Ms|Mrs|Miss)\.? ?[A-Z][a-z]+(?: [A-Z][a-z]+)?)"),
    ("(", rf"(?P<n>{FAMILY_NAME}{GIVEN})(?<![店社部課室場所会院校市町村県])\((?:\d\d|1[01]\d|\d[歳才]|\d\d[歳才])\)(?=[はがをのもと、。])"),
    *((title, rf"(?P<n>{FAMILY_NAME}(?: (?:{K}{{1,3}}|[ぁ-ん]{{2,4}}))?){title}(?!{K})") for title in TITLES),
    ("先生", rf"(?P<n>{FAMILY_NAME}{K}{{2}})先生"),
    ("代表", rf"代表の(?P<n>{FAMILY_NAME}{K}{{2}})(?=[はがも])"),
    ("社長 ", rf"社長 (?P<n>{FAMILY_NAME}{K}{{1,3}})(?!{K})"),
    ("先:", rf"(?:問い?合わ?せ|連絡)先: ?(?P<n>{FAMILY_NAME} {K}{{1,3}})(?!{K})"),
    ("私は", rf"私は(?P<n>{FAMILY_NAME}(?:{K}{{2}})?)(?=です|と申)"),
    ("Dr", r"(?P<n>Dr\.? ?[A-Z][a-z]+(?: [A-Z][a-z]+)?)"),
)]
NO_NAME = re.compile(rf"(?:.*[ぁ-ん])?(?:お|御)?(?:{NO_NAMES})$")
#: One of these occurs in each text with an address or a phone number.
ADDRESS_HINT = re.compile(r"丁目|番地|[\d〇一二三四五六七八九十]番[\d〇一二三四五六七八九十]|\d-\d")
PHONE_HINT = re.compile(r"(?<![0-9.,])0\d|\+81|\(0")
#: Organisational units before a name.
UNIT = re.compile(r"^[一-龥ァ-ヶー]{1,8}[室部課係局店所] ")


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        digits = re.sub(r"\D", "", m[0])
        if m[0][0] == "+":
            ok = 11 <= len(digits) <= 12
        else:
            ok = len(digits) == 10 or len(digits) == 11 and digits[:3] in ("050", "060", "070", "080", "090", "020")
            if ok and m[0].isdigit():  # without separators: a mobile number, or named as a phone
                ok = len(digits) == 11 or bool(PHONE_NEAR.search(text[max(0, m.start() - 14) : m.start()]))
        if ok:
            yield m.span()


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """Begin, end and kind of all personal information in ``text``, in its order and without overlaps."""
    if not text:
        return []
    t, begin, end = normalise(text)
    found: list[tuple[int, int, str]] = []
    if "@" in t:
        found += [(*m.span(), "email") for m in EMAIL.finditer(t)]
    if ID_HINT.search(t):
        found += [(*m.span(m.lastindex), "id_number") for m in ID_NUMBER.finditer(t)]
    if ADDRESS_HINT.search(t):
        found += [(*m.span(), "address") for m in ADDRESS.finditer(t)]
    if PHONE_HINT.search(t):
        found += [(*s, "phone") for s in _phones(t)]
    for hint, pattern in NAMES:
        if hint not in t or hint == "様" and t.count("様") == t.count("様子"):
            continue
        for m in pattern.finditer(t):
            if not NO_NAME.match(m["n"]):
                unit = UNIT.match(m["n"])
                found.append((m.start("n") + (unit.end() if unit else 0), m.end("n"), "name"))
    # a name that runs into an address without a mark keeps its characters
    names = [(a, b) for a, b, kind in found if kind == "name"]
    found = [(max([x, *(b for a, b in names if a < x < b < y)]), y, kind) if kind == "address" else (x, y, kind) for x, y, kind in found]
    rank = {k: i for i, k in enumerate(("email", "id_number", "address", "phone", "name"))}
    found.sort(key=lambda s: (rank[s[2]], s[0], -s[1]))
    kept: list[tuple[int, int, str]] = []
    for a, b, kind in found:
        if all(b <= x or a >= y for x, y, _ in kept):
            kept.append((a, b, kind))
    kept.sort()
    return kept if begin is None else [(begin[a], end[b - 1], kind) for a, b, kind in kept]


def redacted(text: str, found: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in found:
        out += [text[at:a], PLACEHOLDER.format(kind)]
        at = b
    return "".join([*out, text[at:]])


def redact(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, kinds, spans``: texts with placeholders, the kinds found, and the spans in the source (begin, end, kind).

    Null and empty texts come out as they are, without spans. Repeated rows each come out; other columns are ignored; texts of
    any length are searched whole. Numbers of firms, goods and papers, names of firms, and places without a block or house
    number stay.
    """
    source = only(df, id=id_col, text=text_col)
    kind = source.schema["id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [spans(t) for t in texts]
            made = [t if not f else redacted(t, f) for t, f in zip(texts, found)]
            kinds = [sorted({k for _, _, k in f}) for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array([[{"begin": a, "end": b, "kind": k} for a, b, k in f] for f in found], span_type)], names=["id", "text", "kinds", "spans"])

    return source.mapInArrow(run, f"id {kind}, text string, kinds array<string>, spans array<struct<begin:int,end:int,kind:string>>")
