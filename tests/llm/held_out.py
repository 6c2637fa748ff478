"""Captions written without the lists and thresholds of ``residue.py``, to measure on; never move any of them there."""

RESIDUE = [
    # slots
    "{{ product.thumbnail_alt }}", "{{imageDescription}}", "{$row.caption}", "${item.altText}", "<%= @article.headline %>", "<?php the_title(); ?>", "%%POST_TITLE%%", "[[+pagetitle]]", "{{#if hero}}",
    "__MSG_caption__", "##ALT_TEXT##", "海辺の{{spot_name}}", "{photo_credit}提供", "{% block image_alt %}", "[[IMAGE:ALT]]", "@@CAPTION@@", "%{alt_text}", "{{{figcaption}}}", "#{photo.label}", "<% alt %>",
    # values of programs
    "undefined", "写真 null", "NaN × NaN", "[object Object]", "undefined - null", "画像：undefined", "None", "[object Undefined]", "null（撮影：null）", "NaN点の作品",
    # filler
    "Lorem ipsum dolor sit amet", "Lorem ipsum", "ここにキャプションを入力", "ダミーの説明文です。ダミーの説明文です。", "テキストテキストテキストテキスト", "サンプルの文章が入ります", "説明テキストが入ります。説明テキストが入ります。", "Caption text goes here", "Add your caption here",
    "画像の説明をここに書いてください", "この文章はダミーです。文字の大きさを確認しています", "Insert your text here", "Your caption here", "見出しテキストが入ります", "Sample caption text",
    # errors and waiting
    "404 Page Not Found", "HTTP Error 503. The service is unavailable.", "500 - Internal server error", "このページはご利用いただけません", "お探しの商品は見つかりませんでした", "画像の読み込みに失敗しました", "サーバーに接続できませんでした", "The page cannot be found",
    "We're sorry, something went wrong", "Error loading image", "Please wait while the page is loading", "読み込んでいます。しばらくお待ちください", "アクセスしようとしたページは存在しません", "一時的にアクセスできない状態です", "Service temporarily unavailable", "Image failed to load", "エラー：画像を取得できません",
    "指定されたURLは存在しません", "ただいま大変混み合っています。しばらくしてからお試しください", "Gateway Timeout (504)",
    # scripts
    "JavaScriptが有効になっていません", "JavaScriptをONにしてください", "Please enable JavaScript in your browser", "This feature requires JavaScript", "スクリプトをオンにしてからご覧ください", "You must have JavaScript enabled to view this", "ご覧になるにはJavaScriptの設定を有効にしてください", "JavaScript is turned off",
]

NATURAL = [
    "サーバールームの配線を直す技術者", "エラーで出塁した選手の笑顔", "タイトルマッチの計量会場", "テキスト代込みの料理教室", "スクリプトを読む役者たち", "ダミーのケーキが並ぶ棚", "見本市の会場に並ぶサンプル", "無名作家の『無題』という油絵", "アクセス道路の開通式", "ページをめくる子どもの手",
    "404便の機体、成田空港にて", "500系新幹線の先頭車", "503号室からの眺め", "『ページが見つからない』という短編集の表紙", "エラーコインと呼ばれる珍しい硬貨", "準備中の札がかかる蕎麦屋", "待ち時間にお茶を飲む人々", "お待ちかねの花火大会", "ただいまと言って帰る子", "読み込みを練習する落語家",
    "JavaScript勉強会の集合写真", "書店に並ぶJavaScriptの入門書", "スクリプト書体で書かれた看板", "ブラウザゲームの原画展", "クッキーを焼く親子", "[左] 祖母と父、昭和30年ごろ", "{ 波括弧 } をかたどった彫刻", "<北> の出口にある案内板", "100% ウールの毛布", "半額セール 50%OFF の値札",
    "#夕焼け #海 #ひとり旅", "@cafe の限定ラテ", "$20 の古着のジャケット", "A & B の二人展", "Null Island という名の居酒屋", "The Not Found Quartet の演奏", "Undefined Beauty という香水の瓶", "None of them knew: 舞台写真", "Error Bar の店内", "Test kitchen at the old mill",
    "Sample of blue pottery", "A dummy in the shop window", "Loading the boat at dawn", "Waiting for the bus in the rain", "A page from the old atlas", "Title fight at the city hall", "Caption contest winners", "Server at the noodle bar", "Script by a Tang master", "Forbidden City in snow",
    "接続詞を教える先生", "通信簿を見せる兄弟", "失敗した陶器を集めた展示", "有効期限の書かれた牛乳パック", "画像診断室の入口", "説明会に集まった人々", "文章教室の机と椅子", "キャプションのない古い写真", "テストを受ける生徒たち", "指定席から見た舞台",
    "ファイルを抱えた会社員", "システムキッチンの展示場", "メンテナンス工場の見学", "ログハウスの前で", "商品名を彫った木の看板", "コード刺繍のドレス", "内部を見せた時計", "許可を得て撮った神社の内部", "削除された壁画の跡", "セッションを楽しむ奏者たち",
    "ここに立つと富士山が見える", "入力用紙に書き込む人", "仮設住宅の朝", "仮の橋を渡る牛", "しばらく続いた雪の後", "もう一度見たい桜並木",
]
