"""Word lists by language, and a lexicon table for the long ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: sounds and fillers that carry no meaning
EXCLAMATION_KANA = "あいうえおぁぃぅぇぉっーん〜アイウエオァィゥェォッ"
EXCLAMATION_HAN = "啊呀哦嗯哎嘿哟哇嘻呵咳呕咚叮当噼啪哗啦咯唔嘛呃噢嗷呜哼嘶喔吱呱啾嘎哞咩"
EXCLAMATION_EN = "um uh oh ah eh hmm er hmph ugh ack ow whoa hey huh mm hm ha heh meh shh psst ughh argh grr ahem".split()

# fixed values: bracketed editorial markers that are no dialogue
MARKERS = {
    "ja": "音楽 拍手 笑い 歓声 悲鳴 鳴き声 足音 効果音 鐘 笛 雷 風 波 雨 爆発 銃声 車 飛行機 電話 ベル チャイム ノック ドア SE BGM ざわめき どよめき".split(),
    "zh": "音乐 BGM 背景音乐 掌声 笑声 欢呼 尖叫声 哭声 音效 脚步声 钟声 哨声 雷声 风声 海浪 雨声 爆炸 枪声 汽车 飞机 电话 门铃 敲门 开门 SE 嘈杂 骚动 动物叫声".split(),
    "en": ["Music", "BGM", "Applause", "Laughter", "Cheers", "Scream", "SFX", "Sound Effect", "Footsteps", "Bell", "Whistle", "Thunder", "Wind", "Waves", "Rain", "Explosion", "Gunshot", "Car", "Airplane", "Telephone", "Knock", "Door", "SE", "Murmur", "Stir"],
}

# fixed values: titles that mark the word beside them as a name
HONORIFICS = {
    "ja": "さん くん ちゃん 様 殿 博士 警部 殿下 先生 総統 団長 伯爵 署長 所長 船長 部長 社長".split(),
    "zh": "先生 女士 小姐 博士 教授 老师 医生 律师 局长 部长 市长 校长 院长 队长 船长 机长 总统 总理 主席 将军 元帅 司令".split(),
    "en": "mr mrs ms miss dr prof sir lord captain commander general president prince princess duke count senpai sensei sama chan kun san".split(),
}


# fixed values: turns of phrase of translated Chinese and what is said instead, applied one after the other; $1 is the group
NATURAL_ZH = [
    ("进行了([一-鿿]{1,4})", "$1了"),
    ("给予([一-鿿]{1,4})", "给$1"),
    ("有着([一-鿿]{2,6})", "有$1"),
    ("他的(妈妈|爸爸|哥哥|姐姐|弟弟|妹妹|朋友|老师|同学|邻居|同事|老板)", "他$1"),
    ("她的(妈妈|爸爸|哥哥|姐姐|弟弟|妹妹|朋友|老师|同学|邻居|同事|老板)", "她$1"),
    ("对于([你我他她])来说", "对$1来说"),
    ("当([你我他她])的时候", "$1...的时候"),
    ("是否(可以|能够|需要|愿意|知道|明白|清楚|确定)", "$1吗"),
    ("如何(办|做|说|写|处理|解决|解释|描述)", "怎么$1"),
    ("迅速地", "很快"),
    ("非常地", "非常"),
    ("显得格外", "特别"),
    ("正在([一-鿿])着", "在$1"),
    ("的重要性", "很重要"),
    ("具有([一-鿿]{2,6})性", "很$1"),
]


def lexicon(spark: SparkSession, words: dict[tuple[str, str], list[str]]) -> DataFrame:
    """(lang, kind, value) rows from {(lang, kind): words}; long lists live in files and come in by this table."""
    rows = [(lang, kind, w) for (lang, kind), ws in words.items() for w in ws]
    return spark.createDataFrame(rows, "lang string, kind string, value string")
