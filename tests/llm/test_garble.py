import random

import pytest

from tidemill.llm import garble

TEXT = {
    "fr": "L’équipe du matin a été comparée à la clé renommée. Le dépôt numéro deux relâche le câble torsadé près du quai.",
    "de": "Der Übertragungsdienst stützt die Lieferübersicht außerhalb der Öffnungszeiten. Die Wärmepumpe prüft der Zähler.",
    "es": "El catálogo otoñal jamás alcanzó la réplica más antigua. La dirección errónea reescribió el índice de búsqueda.",
    "pt": "A região litorânea também repetiu o cartão de ponto após a migração. A função de cálculo omitiu a descrição vazia.",
    "ru": "Группа контроля подтверждает остаток на складе. Служба доставки восстанавливает журнал изменений, очередь повторов ожидает.",
    "zh": "最早的检索网关影响不到狭窄的变更日志，每小时的合页套件覆盖了未贴标的归档作业。折叠的样品抽屉推迟了缺失的评论。",
}
#: Rare but right.
RIGHT = [
    "ATENÇÃO, SEÇÃO 2: GESTÃO À DISTÂNCIA", "Âge, âme, pâté", "ÉTÉ À L’ÎLE", "Å Ä Ö – åäö", "½ × ¾ ≥ 30 %", "™ © ®", "Ø 12 mm ± 0,5 µm", "¡Ñandú! ¿Güiro?", "œuvre — cœur", "«Ёлка» и съезд",
    "ВАЖНО: №7", "ＡＢＣ １２３ ｶﾀｶﾅ", "한글 색인", "├── intake\n└── outbox", "√2 ≈ 1,41", "naïve café façade", "Straße, GRÖSSE", "x → ∞, ∑ ≤ ∏", "«Р», «С» и «Г»", "10 °C, § 4, № 5", "小校笑效些孝肖", "", "plain",
]


def latin(b):
    return "".join(bytes([x]).decode("cp1252", "ignore") or chr(x) for x in b)


PAIRS = {
    "utf-8 as latin-1": lambda s: s.encode().decode("latin-1"),
    "utf-8 as cp1252": lambda s: latin(s.encode()),
    "utf-8 as cp1251": lambda s: s.encode().decode("cp1251", "replace"),
    "utf-8 as cp437": lambda s: s.encode().decode("cp437"),
    "utf-8 as mac": lambda s: s.encode().decode("mac_roman"),
    "utf-8 as koi8": lambda s: s.encode().decode("koi8_r"),
    "utf-8 as gbk": lambda s: s.encode().decode("gbk", "replace"),
    "utf-8 as big5": lambda s: s.encode().decode("big5", "replace"),
    "twice": lambda s: latin(latin(s.encode()).encode()),
    "bytes lost": lambda s: s.encode("cp1252" if s.isascii() or s[0] < "Ā" else "utf-8", "ignore").decode("ascii", "replace"),
}


@pytest.mark.parametrize("pair", PAIRS)
@pytest.mark.parametrize("lang", TEXT)
def test_every_pair_is_found(pair, lang):
    bad = PAIRS[pair](TEXT[lang])
    assert bad != TEXT[lang] and garble.garbled_spans("Correct words before.\n" + bad + "\nand after.")


@pytest.mark.parametrize("pair", ["utf-8 as latin-1", "utf-8 as cp1252", "utf-8 as cp437", "utf-8 as mac", "twice"])
@pytest.mark.parametrize("lang", TEXT)
def test_restored_and_the_rest_untouched(pair, lang):
    right = "\n".join(RIGHT)
    text = right + "\n" + PAIRS[pair](TEXT[lang]) + "\n" + TEXT["de"]
    got, n, whole = garble.restore(text)
    assert got == right + "\n" + TEXT[lang] + "\n" + TEXT["de"] and n > 0 and whole


@pytest.mark.parametrize("t", [*RIGHT, *TEXT.values()])
def test_right_text_is_left_alone(t):
    assert garble.restore(t) == (t, 0, False)


def test_national_sets():
    assert garble.restore(TEXT["zh"].encode("gbk").decode("latin-1"))[0] == TEXT["zh"]
    assert garble.restore(TEXT["ru"].encode("cp1251").decode("latin-1"))[0] == TEXT["ru"]
    assert garble.restore(TEXT["ru"].encode("koi8_r").decode("latin-1"))[0] == TEXT["ru"]
    assert garble.restore(TEXT["ru"].encode("koi8_r").decode("cp1251"))[0] == TEXT["ru"]


def test_unusual_input():
    assert garble.restore(None) == (None, 0, False)
    assert garble.garbled_spans("\ud800 lone \U0001f468 é") == []
    long = "mot é " * 50_000
    assert garble.garbled_spans(long) == [] and garble.restore(long + "limitÃ©e")[0] == long + "limitée"
    rng = random.Random(1)
    for _ in range(200):
        garble.restore("".join(chr(rng.choice([rng.randint(32, 255), rng.randint(0x400, 0x4FF), rng.randint(0x4E00, 0x9FFF), 0xFFFD])) for _ in range(rng.randint(1, 60))))


def test_frame(spark):
    df = spark.createDataFrame([(1, "limitÃ©e", "a"), (1, "limitÃ©e", "a"), (2, None, "b"), (3, "", "c"), (4, "besch�digt", "d")], "id int, text string, n string")
    got = [(r.id, r.n_garbled, r.restorable, r.restored) for r in garble.find_garbled(df, "text").orderBy("id").collect()]
    assert got == [(1, 1, True, "limitée")] * 2 + [(2, 0, False, None), (3, 0, False, ""), (4, 1, False, "besch�digt")]
    assert garble.find_garbled(df.limit(0), "text", with_text=False).count() == 0
    with pytest.raises(ValueError):
        garble.find_garbled(df.withColumnRenamed("n", "restored"), "text")


SENTENCES = {
    "fr": "L'équipe du matin a été comparée à la clé renommée, près du quai où le câble relâché traîne.",
    'de':"Der Übertragungsdienst stützt die Lieferübersicht außerhalb der Öffnungszeiten, prüft Zähler.",
    'pl':"Zażółć gęślą jaźń, późniejsza dostawa została wysłana z magazynu głównego w Łodzi.",
    'ru':"Группа контроля подтверждает остаток на складе, служба доставки восстанавливает журнал.",
    'zh':"最早的检索网关影响不到狭窄的变更日志，每小时的合页套件覆盖了归档作业。",
    'zht':"最早的檢索閘道影響不到狹窄的變更日誌，每小時的合頁套件覆蓋了歸檔作業。",
    'ja':"最初の検索ゲートウェイは狭い変更ログに影響しません。",
    'ko':"가장 빠른 검색 관문은 좁은 변경 기록에 영향을 주지 않는다.",
    'el':"Η ομάδα ελέγχου επιβεβαιώνει το υπόλοιπο στην αποθήκη.",
    'vi':"Nhóm kiểm soát xác nhận số dư trong kho hàng vào buổi sáng.",
    'ar':"تؤكد مجموعة المراقبة الرصيد في المستودع كل صباح.",
    'he':"קבוצת הבקרה מאשרת את היתרה במחסן בכל בוקר.",
    'hi':"नियंत्रण समूह गोदाम में शेष की पुष्टि करता है।",
    'th':"กลุ่มควบคุมยืนยันยอดคงเหลือในคลังสินค้า",
    'ka':"საკონტროლო ჯგუფი ადასტურებს ნაშთს საწყობში.",
}

LATIN, WEST = "latin_1", ("cp437", "cp850", "mac_roman")
#: (language, set of the text, set it was read as).
NAMED = [
    *((x, "utf-8", y) for y in ("iso8859_2", "cp852", "iso8859_7", "cp1253", "cp1257", LATIN, "cp437") for x in ("fr", "de", "ru", "zh", "vi")),
    *((x, "utf-8", LATIN) for x in ("ar", "he", "hi", "th", "ka")),
    ("ru", "cp1251", "mac_roman"), ("zh", "gbk", "cp1251"), ("zht", "big5", LATIN), ("ja", "cp932", LATIN), ("ja", "euc_jp", LATIN), ("ko", "euc_kr", LATIN), ("el", "cp1253", LATIN),
    *((x, LATIN, y) for y in ("cp1251", *WEST) for x in ("fr", "de")), *(("fr", x, LATIN) for x in WEST),
    ("pl", "cp1250", LATIN), ("pl", "iso8859_2", LATIN), ("ru", "cp866", LATIN), ("ru", "cp1251", "cp437"), ("ja", "cp932", "gbk"), ("zh", "gbk", "big5"), ("zht", "big5", "gbk"), ("zh", "gbk", "cp949"),
    ("zh", "gbk", LATIN), ("ru", "cp1251", LATIN), ("ru", "koi8_r", LATIN), ("ru", "koi8_r", "cp1251"), ("ru", "cp866", "cp1251"), ("ru", "cp1251", "koi8_r"), ("ru", "iso8859_5", "cp1251"),
]
#: Not found: both readings are words of letters that stand where they may.
NOT_FOUND = [("fr", LATIN, "cp1250"), ("ru", "mac_cyrillic", "cp1251"), ("ru", "iso8859_5", "koi8_r"), ("ko", "euc_kr", "gbk")]


def misread(lang, meant, read):
    raw = SENTENCES[lang].encode(meant, "ignore")
    lines = "Correct words before.\n{}\nand after."
    return lines.format(raw.decode(meant)), lines.format(raw.decode(read, "replace"))


@pytest.mark.parametrize("case", NAMED, ids="-".join)
def test_named_pairs_are_found_and_never_restored_wrongly(case):
    want, bad = misread(*case)
    got, n, whole = garble.restore(bad)
    assert n > 0 and (got == want or not whole or same_but_for_lost(got, want))


def same_but_for_lost(got, want):
    return len(got) == len(want) and sum(a != b for a, b in zip(got, want)) <= 2


@pytest.mark.parametrize("case", [("fr", "utf-8", "cp852"), ("ru", "utf-8", "iso8859_2"), ("hi", "utf-8", LATIN), ("zht", "big5", LATIN), ("ja", "cp932", LATIN), ("ko", "euc_kr", LATIN), ("fr", "cp850", LATIN), ("pl", "iso8859_2", LATIN), ("ru", "cp866", LATIN), ("zh", "gbk", "cp1251"), ("ru", "cp1251", LATIN)], ids="-".join)
def test_named_pairs_restored(case):
    want, bad = misread(*case)
    assert garble.restore(bad)[::2] == (want, True)


@pytest.mark.parametrize("case", NOT_FOUND, ids="-".join)
def test_what_is_not_found_is_left_alone(case):
    _, bad = misread(*case)
    assert garble.restore(bad) == (bad, 0, False)


@pytest.mark.parametrize("lang", SENTENCES)
def test_right_sentences_of_any_script_are_left_alone(lang):
    assert garble.restore(SENTENCES[lang]) == (SENTENCES[lang], 0, False)


@pytest.mark.parametrize("t", ["MAÇÃ® boa", "A text that speaks of U+FFFD, the sign � of lost bytes.", "Ｆｕｌｌ ｗｉｄｔｈ ｗｏｒｄｓ, １２ ｒａｃｋｓ", "Nestlé® und Café™", "Δt = 5 µm, kΩ, α-Test"])
def test_odd_but_right(t):
    assert garble.restore(t) == (t, 0, False)
