import pytest

from tsumugi.llm.pii import normalise, redact, redacted, spans

FOUND = [
    ("照会はk.mizu+news@lab.invalid で受け付ける。", "照会は[email] で受け付ける。"),
    ("宛先はｔｏｍａ６０＠ｍａｉｌ．ｅｘａｍｐｌｅ。", "宛先は[email]。"),
    ("資料はdesk [at] mail.exampleへ", "資料は[email]へ"),
    ("資料はdesk（アット）mail（ドット）exampleへ", "資料は[email]へ"),
    ("info@​mail.example", "[email]"),
    ("rіkuto@shion.test", "[email]"),
    ("電話は03-0012-3456まで", "電話は[phone]まで"),
    ("携帯（０９０－０７８４－８６０８）", "携帯（[phone]）"),
    ("TEL (045)048-2477 に", "TEL [phone] に"),
    ("06（0616）2109", "[phone]"),
    ("+81-80-0386-2957", "[phone]"),
    ("連絡先は08000006631", "連絡先は[phone]"),
    ("電話はゼロキュウゼロイチニサンヨンゴロクナナハチです", "電話は[phone]です"),
    ("電話は〇三（〇〇〇一）二三四五です", "電話は[phone]です"),
    ("個人番号 0129 4292 8114が", "個人番号 [id_number]が"),
    ("マイナンバー：０２７５２５１２２４０８が", "マイナンバー：[id_number]が"),
    ("運転免許証番号第053907809085号", "運転免許証番号第[id_number]号"),
    ("旅券番号ZZ0060526と", "旅券番号[id_number]と"),
    ("基礎年金番号0909-100681", "基礎年金番号[id_number]"),
    ("転居先は白嶺県峯淵町月待町3丁目25番14号とされる", "転居先は[address]とされる"),
    ("（〒000-0801 翠丘県樺浦町桐ヶ丘7-3-18 みなと荘508号室）", "（[address]）"),
    ("届け先：燈井市日向坂四丁目三番地。", "届け先：[address]。"),
    ("（5-10-18 Wakabadai, Shiraho-shi）", "（[address]）"),
    ("広報室 霞ヶ瀬様気付", "広報室 [name]様気付"),
    ("申込者 水篠 そよぎ様、", "申込者 [name]様、"),
    ("被害を訴えることねさん（54）は", "被害を訴える[name]さん（54）は"),
    ("取材に応じた葛ノ畑みやび氏は", "取材に応じた[name]氏は"),
    ("マサゴブチ トウマ様あて", "[name]様あて"),
    ("Ms. Itto Mizushino は", "[name] は"),
    ("（文責・千種浦）", "（文責・[name]）"),
    ("田中太郎（34）は退職した。", "[name]（34）は退職した。"),
    ("中村浩二（４１歳）を採用", "[name]（４１歳）を採用"),
    ("代表の佐藤健一が語った。", "代表の[name]が語った。"),
    ("問い合わせ先：鈴木 一郎（総務部）", "問い合わせ先：[name]（総務部）"),
    ("私は高橋です。", "私は[name]です。"),
    ("伊藤課長が", "[name]課長が"),
    ("加藤美咲先生", "[name]先生"),
    ("渡辺君は", "[name]君は"),
    ("社長 小林誠", "社長 [name]"),
    ("０３ー１２３４ー５６７８", "[phone]"),
    ("電話は零三・一二三四・五六七八です", "電話は[phone]です"),
    ("taro あっと example ドットコム", "[email]"),
]
KEPT = ["山田工業社長は", "林業課長は", "森林部長", "資料(12)は", "松本市部長", "田中商店（3）の", "コーヒー", "単価は@412円で据え置く。", "公式アカウント@nagi_040 で告知した。", "法人番号は9873636979801である。", "伝票番号は4853-2655-3085だった。", "受付番号2031-3285-8468で管理する。", "口径62-13-4769の管を使う。", "担当者さんの声も掲載した。", "お客様と皆様", "当面は様子を見る構えだ。", "緑沢浦商事も会合に加わった。", "碧原県灯坂町の拠点で", "2024-05-01と12.5％", "型番はRT-5669-7576に統一した。", "新任取締役の改善余地は継続的だ。", "氏名は伏せた。", "同様の仕様で多様な模様", "", "  "]


@pytest.mark.parametrize("text,expected", FOUND)
def test_found(text, expected):
    assert redacted(text, spans(text)) == expected


def test_a_name_glued_to_an_address():
    assert [k for _, _, k in spans("氏名：篝谷 一灯東雲府暁塚市南区水車町8丁目2番3号の自宅に")] == ["name", "address"]


@pytest.mark.parametrize("text", KEPT)
def test_kept(text):
    assert spans(text) == []


@pytest.mark.parametrize("text", [t for t, _ in FOUND] + ["ｶﾞ​ギﾟ⽇", "が゚〇〇〇〇〇〇〇〇〇〇"])
def test_offsets_lead_back(text):
    t, begin, end = normalise(text)
    assert begin is None and len(t) == len(text) or len(begin) == len(end) == len(t) and all(0 <= a < b <= len(text) for a, b in zip(begin, end)) and begin == sorted(begin)


def test_redact(spark):
    long = "静かな文章。" * 20_000 + "電話は03-0012-3456まで。" + "静かな文章。" * 10
    rows = [(1, FOUND[0][0], "x"), (1, FOUND[0][0], "x"), (2, None, None), (3, "", "y"), (4, long, "z")]
    got = redact(spark.createDataFrame(rows, "aug_id bigint, body string, text string"), "aug_id", "body").collect()
    assert [(r["id"], r["kinds"]) for r in sorted(got, key=lambda r: r["id"])] == [(1, ["email"]), (1, ["email"]), (2, []), (3, []), (4, ["phone"])]
    by = {r["id"]: r for r in got}
    assert by[2]["text"] is None and by[3]["text"] == "" and "[phone]" in by[4]["text"]
    s = by[1]["spans"][0]
    assert FOUND[0][0][s["begin"] : s["end"]] == "k.mizu+news@lab.invalid"
    assert redact(spark.createDataFrame([], "aug_id bigint, body string"), "aug_id", "body").count() == 0
