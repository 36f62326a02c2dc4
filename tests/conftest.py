import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from wordlens.session import checkpoint_dir  # noqa: E402
from wordlens.sources.corpus import build_corpus  # noqa: E402
from wordlens.sources.tokenizers import PresegmentedTokenizer  # noqa: E402

# The nine test sentences, hand-segmented (FIXTURES.md section 2).
NINE = [
    "これ に は 私 ばかり で なく 、 ほか の 多く の 人 も 不思議 に 思っ た 。",
    "事実 はたん の 小説 より も 、 奇 なる ばかり で は なく 、 より 劇的 だ よ 。",
    "彼 は 、 この 女 の 人 が 美しい ばかり で なく 、 頭 も よさ そう な こと を 見 て とっ た 。",
    "私 は 土地 を 失っ た ばかり で なく 、 それ に つぎ込ん だ 心血 まで 、 すっかり なくし て しまっ た 。",
    "たぶん 天 皇 は 、 民衆 の 苦しみ の 象徴 で ある ばかり で なく 、 この 負け戦 の 最大 の 犠牲 者 で あっ た の だろう 。",
    "彼女 は 、 たいてい の 人 が そう し たい と いう 気 を 起こす よう に 、 事実 を 曲げよう と も し なかっ た "
    "ばかり か 、 驚く ほど の 率直 さ で 、 まっすぐ 要点 を いっ て のけ た の だ 。",
    "友人 は 自身 演奏 が たいへん 巧み で ある ばかり で なく 、 作曲 に かけ て も なみなみ なら ぬ 手腕 を もっ て "
    "いる と いう 、 音楽 熱心 の 男 で ある 。",
    "連合 軍 の 注意 を 主 攻撃 から そらし た ばかり で なく 、 連合 軍 機動 兵力 の 大 部分 を 同 方面 に 吸収 し て しまっ た 。",
    "ピーター さん は 日本 に 行く こと は 、 友人 ばかり で なく 、 家族 で さえ も 知り ませ ん でし た 。",
]


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[2]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def nine(spark):
    """Corpus of the nine sentences: doc_id 0..8, one sentence each."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(NINE)], "doc_id long, text string")
    return build_corpus(df, tokenizer=PresegmentedTokenizer(), splitter="none")


def by_doc(rows, col):
    return [r[col] for r in sorted(rows, key=lambda r: r["doc_id"])]
