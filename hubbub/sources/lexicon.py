"""User dictionaries, weighted dictionaries and stop words."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hubbub.functions.text import strip_ws
from hubbub.schemas import LEXICON

# Default stop words. Entries of a single character are left out, because the
# term filter drops every one-character word anyway.
STOP_WORDS = tuple(
    """
可以 真的 不錯 應該 不然 然後 自己 就是 除了 好像 不是 還是
只有 可能 現在 一樣 只能 謝謝 不會 少來 一下 不要 建議 看看
聽說 只是 只好 還有 還會 很多 沒有 其他 知道 大家 左右 不用
似乎 疑似 貌似 不行 但是 可是 很想 超想 很好 那麼 已經
以上 以下 大約 所以 所有 全部 如果 假如 大概 無論 怎樣
到底 究竟 什麼 因為 覺得 基本上 這裡 這些 那些 這個 這樣
一直 一定 本來 這邊 那邊 這種 那種 怎麼 怎麼辦 有人 而已 這麼
不過 其實 還能 而是 或是 或者 把特 而且 並且 真是 這是
是不是 有沒有 對不對 對吧 一堆 感覺 直接 當天 當時 那時
趕快 盡量 繼續 最後 只會 沒差 一起 當初 反正 反而 反倒是 反倒
一點 我們 會不會 還在 這誰 這哪位 哪位 這次 當然 必然 這位
以及 甚至 相當 至少 雖然 竟然 居然 還好 幸好 所幸
近期 最近 今天 今年 明年 去年 這回 之前 原先 原本 原來
版主 版大 原Po 原po 推推 各位 安安
哈哈 笑死 XD XDD XDDD QQ qq xd 嘻嘻 呵呵 顆顆
-- ... ..
https http www .tw// com imgur jpeg png gif jpg svg
""".split()
)


def read_user_dictionary(spark, path, header="^【.*】$", weight=1.0):
    """Read a word list with section header lines; headers and blank lines are no words.

    A word listed twice keeps its first section. A dictionary is a hand-kept file, read whole
    because its sections are defined by line order.
    """
    lines = (
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", r"\r?\n|\r")).alias("line", "raw"))
        .select("file", "line", strip_ws("raw").alias("word"))
        .where(F.col("word") != "")
    )
    is_header = F.col("word").rlike(header)
    order = Window.partitionBy("file").orderBy("line")
    sectioned = lines.withColumn("section", F.last(F.when(is_header, F.col("word")), ignorenulls=True).over(order))
    return (
        sectioned.where(~is_header)
        .groupBy("word").agg(F.min_by("section", F.struct("file", "line")).alias("section"))
        .select("word", F.lit(weight).alias("weight"), F.lit(None).cast("string").alias("tag"), "section")
    )


def weighted_dictionary(spark, weights, tags=None):
    """Lexicon from a word-to-weight map; empty words and non-numeric weights are dropped."""
    tags = tags or {}
    rows = [
        (word, float(weight), tags.get(word), None) for word, weight in weights.items()
        if word and isinstance(weight, (int, float)) and not isinstance(weight, bool)
    ]
    return spark.createDataFrame(rows, LEXICON)


def read_stop_words(spark, path):
    """Stop words from a text file, one per line."""
    return spark.read.text(path).select(strip_ws("value").alias("word")).where(F.col("word") != "").distinct()
