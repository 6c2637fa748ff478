from collections import Counter

import numpy as np
import pytest

from millrace.llm.ciphers import CODES, byte_grams, languages, learn_mapping, letter_grams
from millrace.llm.mojibake import Learned, Reader, as_texts, garbled_rows, letter_table, restored_texts

TITLES = [f"{a}の{b}について聞くと、「{c}」という答えだった。" for a in ("港町", "市場", "広場", "会館") for b in ("伴奏", "稲穂", "旅館", "釉薬", "判決文") for c in ("時間をかけて直した", "久しぶりに訪ねた", "昨年の秋から始めた")]
WHOLE = "市場の旅館について聞くと、久しぶりに訪ねたという答えだった。"
SWAPS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1251"), ("utf-8", "mac_roman"), ("cp932", "cp1252"), ("euc_jp", "latin-1"), ("utf-8", "cp932"), ("euc_jp", "cp932"), ("cp932", "utf-8")]
RIGHT = ["Größe: Übergroß, Mitte", "À l’été: œuvres de Hana", "縺れた糸をほどく広場", "Рынок в городе", "«Ã» in the old alphabet", "表彰台、ｴｹｱｳ町にて。", "50€ £40 ¥6000", "Café au lait"]


def misread(text: str, encoding: str, page: str) -> str:
    def one(b: bytes) -> str:
        return b.decode(page, "replace") if page in ("utf-8", "cp932") else "".join(_letter(bytes([x]), page) for x in b)

    return one(text.encode(encoding))


def _letter(b: bytes, page: str) -> str:
    try:
        return b.decode(page)
    except UnicodeDecodeError:
        return chr(b[0])


def rows():
    out = [(i, t, f"https://s{i % 5}.example/") for i, t in enumerate(TITLES * 4)]
    at = 1000
    for encoding, page in SWAPS:
        out.append((at, misread(WHOLE, encoding, page), "https://s1.example/"))
        at += 1
    out.append((1100, "港町の" + misread("伴奏について聞くと", "utf-8", "cp1252"), None))
    out.append((1101, misread(misread(WHOLE, "utf-8", "cp1252"), "utf-8", "cp1252"), "https://s2.example/"))
    out.append((1102, WHOLE.encode("iso2022_jp").decode("ascii").replace("\x1b", ""), "https://s2.example/"))
    out.append((1103, "市場の旅�館", "https://s2.example/"))
    out += [(2000 + i, t, "https://s3.example/") for i, t in enumerate(RIGHT)]
    return [*out, (None, "x", None), (3000, None, None), (3001, "", None)]


@pytest.fixture(scope="module")
def texts(spark):
    df = spark.createDataFrame([(*r, "x") for r in rows()], "pair_id bigint, caption string, page_url string, source string")
    return as_texts(df, "pair.caption", "pair_id", "caption", "page_url")


def test_found(texts):
    found = {r.row_id for r in garbled_rows(texts).collect()}
    assert found >= {*range(1000, 1000 + len(SWAPS)), 1100, 1101, 1102, 1103}
    assert not {i for i in found if i < 1000 or i >= 2000}
    assert garbled_rows(texts.limit(0)).count() == 0


def test_restored(texts):
    got = {r.row_id: r.restored for r in restored_texts(texts).collect()}
    exact = [i for i, (e, p) in enumerate(SWAPS) if p not in ("utf-8", "cp932")]
    assert [got[1000 + i] for i in exact] == [WHOLE] * len(exact)
    assert got[1100] == "港町の伴奏について聞くと" and got[1101] == WHOLE and got[1102] == WHOLE


def test_long_and_odd_texts_end_soon(spark):
    odd = ["$B" * 200_000, "\u00e9" + "a" * 400_000, "\u00e9a" * 200_000, "\uff71" * 200_000, "$B(B" * 50_000]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(odd)], "pair_id bigint, caption string, page_url string")
    assert garbled_rows(as_texts(df, "pair.caption", "pair_id", "caption", "page_url")).count() <= len(odd)


PLACES = "港町 市場 広場 会館 図書館 海辺 神社 商店街 温泉 植物園 工房 駅前".split()
THINGS = "伴奏 稲穂 旅館 釉薬 判決文 椅子 手紙 果樹園 カメラ 自転車 陶器 地図".split()
DEEDS = "時間をかけて直した 久しぶりに訪ねた 昨年の秋から始めた 静かに見ていた 友人と写真を撮った 朝早くから並んだ 雨の中で待っていた".split()
SENTENCES = [f"{a}の{b}について聞くと、{c}という。" for a in PLACES for b in THINGS for c in DEEDS]
PERMUTED = dict(zip(range(0x80, 0x100), sorted(range(0x80, 0x100), key=lambda x: x * 89 % 128)))
UNKNOWN = [("utf-8", "cp866", None), ("utf-8", "cp850", None), ("utf-8", "cp1257", None), ("utf-8", "cp1252", PERMUTED), ("euc_jp", "cp866", None), ("cp932", "cp866", None)]


def permuted(text: str, encoding: str, page: str, moved: dict | None) -> str:
    return "".join(chr(b) if b < 0x80 else _letter(bytes([moved[b] if moved else b]), page) for b in text.encode(encoding))


def unknown_rows(encoding, page, moved, n):
    chosen = SENTENCES[:: len(SENTENCES) // n][:n]
    clean = [(i, t, f"https://s{i % 7}.example/") for i, t in enumerate(SENTENCES)]
    garbled = [(10_000 + i, permuted(t, encoding, page, moved), f"https://{'one' if moved else f'g{i % 40}'}.example/") for i, t in enumerate(chosen)]
    return [*clean, *garbled, *((20_000 + i, t, "https://s3.example/") for i, t in enumerate(RIGHT))], chosen


@pytest.mark.parametrize("encoding, page, moved", UNKNOWN)
def test_unknown_pages_are_learned(spark, encoding, page, moved):
    rows, chosen = unknown_rows(encoding, page, moved, 150)
    df = as_texts(spark.createDataFrame(rows, "pair_id bigint, caption string, page_url string"), "pair.caption", "pair_id", "caption", "page_url")
    got = {r.row_id: r.restored for r in restored_texts(df).collect()}
    garbled = range(10_000, 10_000 + len(chosen))
    assert not [i for i in got if i not in garbled]
    # Without what EM learned they are hardly found or not restored.
    reader = Reader(Learned(df).counts)
    plain = [t for i, t, _ in rows if i in garbled]
    assert sum(reader.restored(t, None) == c for t, c in zip(plain, chosen)) == 0
    assert sum(i in got for i in garbled) >= 0.98 * len(chosen)
    alike = [sum((Counter(got.get(i, "")) & Counter(c)).values()) / len(c) for i, c in zip(garbled, chosen)]
    assert sum(alike) / len(alike) >= (0.6 if encoding == "cp932" else 0.93)
    assert not moved or [got[i] for i in garbled] == chosen


def test_foreign_texts_are_no_cipher(spark):
    russian = "Рынок в городе открыт каждый день. Сегодня мы говорили о новых правилах для школ и о том, как проходят занятия. Москва является столицей и крупнейшим городом страны."
    greek = "Η αγορά της πόλης είναι ανοιχτή κάθε μέρα. Σήμερα μιλήσαμε για τους νέους κανόνες των σχολείων."
    rows = [(i, t, None) for i, t in enumerate(SENTENCES[::3])] + [(5000 + i, x[k : k + 40], "https://r.example/") for x in (russian, greek) for k, i in zip(range(0, len(x), 40), range(99))]
    df = as_texts(spark.createDataFrame(rows, "pair_id bigint, caption string, page_url string"), "pair.caption", "pair_id", "caption", "page_url")
    assert garbled_rows(df).count() == 0


def test_a_source_overrules_the_published_page():
    code = CODES[0]
    language = languages(byte_grams(SENTENCES))[code.name]
    swapped = dict(zip(range(0x80, 0x100), range(0x80, 0x100)))
    swapped[0x81], swapped[0x82] = 0x82, 0x81  # two bytes the other way round
    grams = Counter(g for t in SENTENCES[::5] for g in letter_grams(permuted(t, "utf-8", "latin-1", swapped)))
    fit = learn_mapping(np.array(list(grams)), np.array(list(grams.values())), code, language, letter_table("latin-1"))
    assert fit.good() and fit.table[0x82] == 0x81 and fit.table[0x81] == 0x82 and fit.table[0xE3] == 0xE3
