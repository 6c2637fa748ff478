"""Template residue and error-page text (problem 5).

Character n-gram models of slots, of filler and notices, and of natural text
give each character of a caption a log-likelihood ratio; the windows of
largest sum localise the residue.  A slot or a program's empty value counts
wherever it stands; filler and notices count when their windows cover enough
of the caption, since descriptions may mention such words.

The residue models are fitted to the short examples below, the natural one to
the distinct values of all rows.  It is of lower order, so that it knows the letters of the residue
among those rows but not its phrases.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.ngrams import BITS, ORDER, START, Model, add_counts, codes_of, gather_counts, gram_indexes

# Examples the models are fitted to (fixed values).
NAMES = (
    "name title caption alt text image image_alt img img_alt IMG_ALT photo photo.title photo.caption photo.alt site_name SITE_NAME shop_name SHOP_NAME "
    "product_name product.name product.desc product.title item_name item.name item.title user.name username author AUTHOR date DATE place TITLE NAME CAPTION "
    "filename file_name FILENAME url link label description desc post.title post.excerpt page.title i18n.key placeholder value key category"
).split()
SLOTS = (
    "{{%s}}|{{ %s }}|{{{%s}}}|{%s}|${%s}|#{%s}|<%%= %s %%>|<?php echo $%s; ?>|<?= $%s ?>|{!! $%s !!}|[%s]|[[%s]]|%%%s%%|__%s__|@@%s@@|"
    "###%s###|:%s:|&lt;%s&gt;|<!-- %s -->|{%% %s %%}|{%%- if %s -%%}|%%(%s)s|$%s$|<%s>|@Model.%s|@Html.%s|@item.%s"
).split("|")
FORMATS = ["%d枚目", "%s", "%s さん", "%dページ", "%s の写真", "第%d回", "%1$s", "{0}", "%@", "%d photos", "{%- endif -%}", "{% endfor %}", "{%- if image -%}", "{% if alt %}", "{{#each items}}", "<!-- image caption -->", "<!-- caption here -->"]
#: Values of programs and filler that are residue wherever they stand as words.
EMPTIES = [
    "undefined", "null", "NULL", "NaN", "None", "nil", "[object Object]", "(null)", "(empty)", "undefined undefined", "写真：undefined", "写真: null", "画像：NaN",
    "：undefined（", "：null（", "[object Object] at ", "[object HTMLImageElement]", "translation missing: ja.photos.alt", "translation missing ja.photos.alt",
    ":image_alt missing: translation missing", "#REF!", "#N/A", "#VALUE!", "(no title)", "NaN円",
]
#: Opening words of filler, which give it away whatever follows.
OPENINGS = ["Lorem ipsum", "Lorem ipsum dolor sit amet", "lorem ipsum", "LOREM IPSUM", "Ipsum lorem", "ipsum lorem", "Ipsum lorem lorem"]
FILLER = [
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.",
    "Lorem ipsum", "lorem ipsum dolor", "ipsum lorem dolor sit", "Ipsum lorem lorem", "Ut enim ad minim veniam quis nostrud", "ダミーテキスト", "ダミーテキストです", "この文章はダミーです", "この文章はダミーです。文字の大きさ、量、字間、行間等を確認するために入れています。",
    "文字の大きさや行間を確認するために入れています", "サンプルテキスト", "サンプルテキストサンプルテキスト", "テキストテキストテキスト", "テキストが入ります", "ここにテキストが入ります", "ここに文章が入ります", "ここに説明が入ります", "ここに説明文が入ります", "ここにキャプションが入ります",
    "説明文が入ります", "文章が入ります。文章が入ります。", "キャプションが入ります", "タイトルが入ります", "見出しが入ります", "画像の説明を入力してください", "ここに画像の説明を入力してください", "ここに説明を入力してください", "テキストを入力してください", "タイトルを入力", "仮の文章です", "仮の文章です。仮の文章です。", "画像の準備中につき仮の文章です", "仮テキスト", "仮テキストです", "仮テキストが入ります", "商品名商品名商品名", "商品名が入ります", "○○○○○○", "○○○の画像が入ります", "ダミーダミーダミー", "サンプルサンプルサンプル",
    "あああああ", "テストテストテスト", "これはテストです", "placeholder text", "Placeholder image", "Your text here", "Insert caption here", "Add a caption here", "Add description here", "description goes here", "caption goes here", "Image description goes here", "title goes here", "Enter text here", "Type your text here", "sample text sample text", "Sample text", "dummy text", "This is dummy text", "text text text", "Hello world!", "Hello World", "hello, world", "test test test", "asdf asdf", "xxxxxx", "TODO: write caption", "TBD", "Just another blog", "ブロックをここに追加", "No description available", "画像がありません", "画像なし", "写真なし", "代替テキスト", "代替テキストが入ります", "説明なし", "NO IMAGE", "No image available", "Image not available", "Image coming soon", "Now printing", "準備中です",
]
NOTICES = [
    "Oops! Page not found", "Oops! Something went wrong", "That page can't be found", "This page isn't available", "データベース接続エラー", "ネットワークエラー", "読み込みエラー", "タイムアウトエラー", "接続が切断されました",
    "Not Found", "403 Forbidden", "Forbidden", "500 Internal Server Error", "Internal Server Error", "502 Bad Gateway", "503 Service Unavailable", "Service Unavailable", "504 Gateway Timeout", "Bad Request", "Page not found", "The page you requested could not be found", "The requested URL was not found on this server", "The requested URL /images/ was not found on this server", "This page could not be found", "File not found",
    "Access denied", "Permission denied", "Request failed", "Error 500: request failed", "request failed", "Connection refused", "Connection timed out", "ERR_CONNECTION_TIMED_OUT", "ERR_CONNECTION_REFUSED", "ERR_NAME_NOT_RESOLVED", "Something went wrong", "Something went wrong. Please try again later", "An error occurred", "An unexpected error has occurred", "Unexpected error", "Unable to load content", "Unable to load image", "Failed to load image", "Failed to load resource", "Could not load", "Please try again later", "Please wait", "Loading...", "Now loading", "Loading, please wait", "Just a moment...", "Checking your browser before accessing", "Session expired", "Your session has expired", "Fatal error: Uncaught exception in index.php on line 12", "Fatal error: Allowed memory size exhausted", "Warning: Undefined variable in index.php on line 3", "Parse error: syntax error", "Notice: Undefined index", "Uncaught TypeError: Cannot read properties of undefined", "Traceback (most recent call last)", "Database connection error", "Error establishing a database connection", "Too many requests", "Under maintenance", "This site is under maintenance", "Account suspended", "Content unavailable", "This content is not available", "Coming soon",
    "お探しのページは見つかりませんでした", "お探しのページは見つかりません", "ページが見つかりません", "ページが見つかりませんでした", "指定されたページは存在しません", "指定されたファイルは存在しません", "指定されたページが見つかりません", "ファイルが見つかりません", "画像が見つかりません", "画像を読み込めません", "画像を読み込めませんでした", "画像を表示できません", "お探しの画像は削除されました", "エラーが発生しました", "エラーが発生しました（コード 500）", "予期しないエラーが発生しました", "システムエラーが発生しました", "サーバーエラー", "サーバーエラー（500）", "サーバーエラーが発生しました", "内部エラー", "エラーコード：500", "エラー：読み込みに失敗しました", "読み込みに失敗しました", "接続に失敗しました", "通信エラー", "タイムアウトしました", "アクセスが集中しています", "ただいまアクセスが集中しています", "しばらくお待ちください", "しばらくしてからもう一度お試しください", "しばらく経ってからアクセスしてください", "読み込み中です", "読み込み中...", "ロード中", "ただいまメンテナンス中です", "メンテナンス中", "アクセスが拒否されました", "アクセス権限がありません", "このページは表示できません", "このページは削除されました", "このコンテンツは表示できません", "ページの有効期限が切れました", "セッションの有効期限が切れました", "有効期限が切れています", "ログインしてください", "再読み込みしてください",
    "JavaScriptを有効にしてください", "JavaScriptが無効になっています", "JavaScriptをオンにしてください", "JavaScript設定をオンにしてください", "ブラウザのJavaScript設定をオンにしてご覧ください", "このサイトの閲覧にはJavaScriptが必要です", "当サイトの閲覧にはJavaScriptが必要です", "閲覧にはJavaScriptが必要です", "このページを表示するにはJavaScriptを有効にする必要があります", "スクリプトが無効になっています", "スクリプトを有効にしてください", "お使いのブラウザは対応していません", "You need to enable JavaScript to run this app", "You need to enable JavaScript to view this page", "Please enable JavaScript", "Please enable JavaScript to continue", "Please turn on JavaScript", "JavaScript is required", "JavaScript is disabled in your browser", "JavaScript must be enabled", "This page requires JavaScript", "This page requires scripts", "This site requires scripts to be enabled", "Enable JavaScript and cookies to continue", "Your browser does not support", "Please enable cookies",
]
#: Notices that come with a status code, and the codes.
CODED = "%d Not Found|%d エラー|エラー %d|エラー（%d）|エラーコード：%d|サーバーエラー（%d）|HTTP %d|HTTP Status %d|Status: %d|HTTP エラー %d|HTTP Error %d|Error %d|Error %d: request failed|%d error|Error code: %d|エラーが発生しました（コード %d）|エラーが発生しました（サーバー %d）".split("|")
CODES = (400, 401, 403, 404, 405, 408, 410, 429, 500, 501, 502, 503, 504)
#: Descriptions that only resemble residue.
CONTRAST = [
    "[左から] 田中さん、兄、妹", "[右] 駅前", "[写真] 山本", "桜 [東京] 3枚組", "#旅 #朝 #空", "#photo #travel", "{ 括弧 } の形をした作品", "集合 {x|x>1} の図", "<大> と <小> の皿", "<左> と <右>", "セール $12.50(BOX入り)", "$5 の値札", "100%sweet缶", "果汁100%の缶", "50%off セール", "90%silk shawl", "春__2014__夏", "12:30:45", "404号室のドア", "404 号室", "500周年 404号室", "500円均一の籠", "the 404 bus to the station", "No. 404 locomotive", "Not Found という題の絵", "Loading という題の版画", "『はじめてのJavaScript』の表紙", "JavaScript入門の本", "script の看板", "エラー という曲", "読み込み中の恋", "『読み込み中』公演", "サンプル配布中の店", "ダミー人形の展示", "準備中の札", "準備中の店", "文章が入選", "さんの文章が入選", "作文が入賞", "Null Island と書かれた浮標", "null island の地図", "Undefined という店", "None の看板", "Café Ipsum の看板", "Lorem という犬", "a page of the error atlas", "an error in the map", "test tube", "build script", "null pointer", "sample of soil", "開催中", "50€ £40 price board", "ヌル県", "「？？？」展のポスター", "name tag", "title page of a book", "the title of the book", "photo of the shop", "image of a cat", "caption of the painting", "待合室でお待ちください", "名前 [本名]",
]

#: Phrases in which any noun of the notices may describe an image.
NOUN_PHRASES = "%sの写真|%sを持つ人|%sという題の絵|新しい%s|%s展|%sのある部屋|%sについての本、表紙|古い%sと犬|%s用の棚|%s係の人たち|「%s」".split("|")
ENGLISH_PHRASES = "a %s in the window|the old %s|%s at the market|two people with a %s|%s, oil on canvas".split("|")

#: Order of the natural model: too low to learn by heart the residue among the rows it is fitted to.
NATURAL_ORDER = 3
#: Contexts that make up less than about this share of all characters say little: the natural model backs off there.
BACK_OFF = 1e-3
#: Weight of titles and page texts against captions, and of a contrasting example as a share of all characters counted.
PROSE_WEIGHT, CONTRAST_SHARE = 0.2, 5e-8
#: Window sums (nats) that a slot, an empty value, an opening of filler and a filler or notice need, and the share of the caption the last must cover.
SLOT_SUM, EMPTY_SUM, OPENING_SUM, NOTICE_SUM, COVERAGE = 10.0, 10.0, 20.0, 7.0, 0.42
#: What copies of a caption can speak for it at most (nats): enough for a short general word, not for residue that many rows have.
COPIES_SUM = 8.0
#: Log weight of the model of descriptions with words of notices against the natural one.
PHRASE_LOG = -1.5
#: A window ends where its sum has fallen so far below its best.
DROP = 8.0


def _fitted(texts: list[tuple[list[str], float]]) -> Model:
    counts = np.zeros((ORDER, 1 << BITS))
    for part, weight in texts:
        add_counts(counts, part, weight)
    return Model(counts, 0.35)


def _natural_model(counts: np.ndarray) -> Model:
    counts = np.concatenate([counts, np.zeros((ORDER - len(counts), 1 << BITS))]).astype(np.float64)
    add_counts(counts, CONTRAST, max(1.0, counts[0].sum() * CONTRAST_SHARE))
    return Model(counts, max(3.0, counts[0].sum() * BACK_OFF), order=NATURAL_ORDER)


def _nouns() -> tuple[list[str], list[str]]:
    """Japanese and English words of the filler and notices that aren't such a text, or an opening of one, by themselves."""
    lines = [*FILLER, *NOTICES]
    whole = {x.lower() for x in lines} | {w.lower() for x in OPENINGS for w in x.split()}
    found = {w for x in lines for w in re.findall("[ァ-ヺー]{2,}|[一-鿿]{2,}|JavaScript", x)}
    english = {w.lower() for x in lines for w in re.findall("[A-Za-z]{4,}", x) if x.isascii()}
    return sorted(w for w in found if w.lower() not in whole), sorted(w for w in english if w not in whole)


def _phrase_model() -> Model:
    """Descriptions that hold words of notices, so that such a word alone is no sign of one."""
    japanese, english = _nouns()
    return _fitted([([p % w for w in japanese for p in NOUN_PHRASES] + [p % w for w in english for p in ENGLISH_PHRASES], 1.0), (CONTRAST, 2.0)])


def _residue_models() -> tuple[Model, ...]:
    slots = [pattern % name for pattern in SLOTS for name in NAMES]
    notices = [*FILLER, *NOTICES, *(pattern % code for pattern in CODED for code in CODES)]
    return (
        _fitted([(slots, 1.0), ([f"の{x} 。" for x in slots], 0.25), (FORMATS, 8.0)]),  # within a caption as well
        _fitted([(EMPTIES, 1.0), ([f"：{x}（" for x in EMPTIES], 0.5)]),
        _fitted([(OPENINGS, 1.0)]),
        _fitted([(notices, 2.0), ([f"：{x}（" for x in notices], 1.0), ([f"の{x}。{x}。 " for x in notices], 1.0)]),
    )


def _folded(text: str) -> str:
    """Width forms folded and outer white space off, so that writing matters less."""
    return (text if text.isascii() else unicodedata.normalize("NFKC", text)).strip()


def _windows(ratio: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """Disjoint windows of positive sum, each of ``least`` at least, found by the maximum running sum."""
    out, total, start, best, best_end = [], 0.0, 0, 0.0, 0
    for i, x in enumerate(ratio.tolist()):
        total += x
        if total <= 0 or total < best - DROP:
            if best >= least:
                out.append((start, best_end, best))
            total, start, best = (max(x, 0.0), i, max(x, 0.0)) if total > 0 else (0.0, i + 1, 0.0)
            best_end = i + 1
        elif total > best:
            best, best_end = total, i + 1
    if best >= least:
        out.append((start, best_end, best))
    return out


def _has_symbol(text: str) -> bool:
    return any(not (c.isalnum() or c.isspace()) for c in text)


def _stands_alone(text: str, start: int, end: int) -> bool:
    """Whether a window doesn't begin or end within a word of Latin letters."""
    inner = lambda i: 0 < i < len(text) and text[i - 1].isascii() and text[i].isascii() and text[i - 1].isalpha() and text[i].isalpha()
    return not inner(start) and not inner(end)


class Detector:
    """Says of captions whether they are, or contain, residue; ``natural`` are the counts of distinct values, ``copied`` those of all rows."""

    def __init__(self, natural: np.ndarray, copied: np.ndarray):
        self.natural, self.copied = _natural_model(natural), _natural_model(copied)
        self.slots, self.empties, self.openings, self.notices = _residue_models()
        self.phrases = _phrase_model()

    def _judge(self, kind: str, text: str, windows: list[tuple[int, int, float]]) -> bool:
        spans = [(a, min(b, len(text))) for a, b, _ in windows]
        if kind == "slot":
            return any(_has_symbol(text[a:b]) for a, b in spans)
        if kind == "empty":
            return any(_stands_alone(text, a, b) for a, b in spans)
        return sum(b - a for a, b in spans) >= COVERAGE * max(1, len(text))

    def residue(self, captions: list[str]) -> np.ndarray:
        folded = [_folded(c) for c in captions]
        codes, edges = codes_of(folded)
        grams = gram_indexes(codes)
        base = self.natural.log_probability(grams)
        real = codes != START
        copies = np.where(real, self.copied.log_probability(grams) - base, 0.0)
        described = np.maximum(base, self.phrases.log_probability(grams) + PHRASE_LOG)
        found = np.zeros(len(captions), bool)
        models = (("slot", self.slots, SLOT_SUM), ("empty", self.empties, EMPTY_SUM), ("empty", self.openings, OPENING_SUM), ("notice", self.notices, NOTICE_SUM))
        for kind, model, least in models:
            ratio = np.where(real, model.log_probability(grams) - (described if kind == "notice" else base), 0.0)
            possible = np.add.reduceat(np.maximum(ratio, 0), edges[:-1]) >= least
            for k in np.flatnonzero(possible & ~found):
                first = edges[k] + ORDER - 1
                windows = [(a, b, x) for a, b, x in _windows(ratio[first : edges[k + 1]], least) if x - min(COPIES_SUM, max(0.0, copies[first + a : first + b].sum())) >= least]
                found[k] = bool(windows) and self._judge(kind, folded[k], windows)
        return found


_FOUND = "row_id bigint, residue boolean"


def _captions(batch: pa.RecordBatch, column: int) -> list[str]:
    return [c for c in batch.column(column).to_pylist() if c]


def fit_natural(pairs: DataFrame, caption: str = "caption", title: str = "page_title", text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts of the distinct captions, titles and texts, and of those of all rows."""
    fold = lambda batch: [_folded(x) for column in batch.columns for x in column.to_pylist() if x]
    captions, titles, texts = (gather_counts(pairs.select(c).distinct(), fold, NATURAL_ORDER) for c in (caption, title, text))
    every, prose = (gather_counts(pairs.select(*c), fold, NATURAL_ORDER) for c in ([caption], [title, text]))
    return captions + (titles + texts) * PROSE_WEIGHT, every + prose * PROSE_WEIGHT


def mark_residue(pairs: DataFrame, id_col: str = "pair_id", caption: str = "caption", title: str = "page_title", text: str = "text") -> DataFrame:
    """``row_id, residue``: one row for each row of ``pairs``.

    Null, empty and blank captions are no residue.  An empty table gives an
    empty result.  The distinct values of each column and the bounded counts
    are shuffled.
    """
    natural = [x[:NATURAL_ORDER].astype(np.float32) for x in fit_natural(pairs, caption, title, text)]
    shared = pairs.sparkSession.sparkContext.broadcast(natural)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = Detector(*shared.value)
        for batch in batches:
            captions = [c or "" for c in batch.column(1).to_pylist()]
            flagged = np.zeros(len(captions), bool)
            for at in range(0, len(captions), 5000):
                flagged[at : at + 5000] = detector.residue(captions[at : at + 5000])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flagged)], ["row_id", "residue"])

    return pairs.selectExpr(f"CAST({id_col} AS BIGINT) AS row_id", caption).mapInArrow(run, _FOUND)
