"""Schemas, fixed values and tunable limits shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------- schemas (survey 1.2)

METRICS = ("air_temp", "air_humidity", "soil_humidity", "light")

READING = T.StructType(
    [T.StructField("greenhouse_id", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in METRICS]
    + [T.StructField("timestamp", T.LongType())]
)

# Every field as text: lets the strict parse accept numbers sent as strings.
READING_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in READING])

STATS = ("avg_temp", "avg_humidity", "avg_soil_humidity", "max_light")

WINDOW_STATS = T.StructType(
    [
        T.StructField("greenhouse_id", T.StringType()),
        T.StructField("win_start", T.TimestampType()),
        T.StructField("win_end", T.TimestampType()),
    ]
    + [T.StructField(m, T.DoubleType()) for m in STATS]
)

# reading metric -> statistic of the window tables
STAT_OF = dict(zip(METRICS, STATS))

FEED_METRICS = ("air_temp_avg", "air_humidity_avg", "soil_humidity_avg", "light_avg")

FEED = T.StructType(
    [
        T.StructField("greenhouse_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
    + [T.StructField(m, T.DoubleType()) for m in FEED_METRICS]
)

# short metric names of the comparison reports
SHORT = dict(zip(STATS, ("temp", "hum", "soil", "light")))

DEFAULT_KEY = "gh_01"

# ---------------------------------------------------------------- limits


@dataclass(frozen=True)
class WindowSpec:
    """Window geometry. ``scale`` divides the results: with readings held as
    integers (hundredths, say) the sums are exact, whatever order the shuffle
    delivers them in."""

    seconds: int = 5
    slide_seconds: int = 1
    offset_seconds: int = 0
    watermark: str = "10 seconds"
    scale: int = 1

    @property
    def size(self) -> str:
        return f"{self.seconds} seconds"

    @property
    def slide(self) -> str:
        return f"{self.slide_seconds} seconds"

    @property
    def offset(self) -> str:
        return f"{self.offset_seconds} seconds"


@dataclass(frozen=True)
class AlarmSpec:
    """Alarm gate and look-back. ``bucket_seconds`` bounds the rows one task
    sorts when looking back over a greenhouse's history."""

    hot_above: float = 30.0
    lookback_seconds: int = 60
    bucket_seconds: int = 86400

    def __post_init__(self):
        if self.bucket_seconds < self.lookback_seconds:
            raise ValueError("bucket_seconds must be at least lookback_seconds")


# ---------------------------------------------------------------- fixed values
# Labels, keywords, thresholds, scores and texts below must equal the values the
# existing reports use; they are data, not logic.

LABELS = ("大棚一", "大棚二", "大棚三")

LABEL_OF_KEY = {
    "gh_01": "大棚一",
    "gh_02": "大棚二",
    "gh_03": "大棚三",
    "1": "大棚一",
    "2": "大棚二",
    "3": "大棚三",
}

KEY_OF_LABEL = {"大棚一": "gh_01", "大棚二": "gh_02", "大棚三": "gh_03"}

GREENHOUSE_WORDS = {
    "大棚一": ("大棚一", "大棚 1", "大棚1", "一号棚"),
    "大棚二": ("大棚二", "大棚 2", "大棚2", "二号棚"),
    "大棚三": ("大棚三", "大棚 3", "大棚3", "三号棚"),
}

CAUSE_WORDS = ("为什么", "原因", "归因", "咋回事", "为啥")
HEAT_WORDS = ("高温", "告警", "热", "温度")
ENGINE_WORDS = ("spark", "flink", "双引擎", "引擎差异", "对齐率")
DIFFERENCE_WORDS = ("差异", "对比", "不同", "区别")
ALARM_WORDS = ("告警", "高温", "alarm")
TOP_WORDS = ("最多", "最高", "排行", "哪个棚")
RANK_WORDS = ("对比", "比较", "哪个大棚", "排名", "排行", "最高", "最低", "平均")
SUBJECT_WORDS = ("大棚", "温度", "湿度", "光照")
LATEST_WORDS = ("最近", "当前", "现在", "最新", "多少度", "温度", "湿度", "光照")
AND_WORDS = ("和", "与")

# rule -> tiers (threshold, score), strongest first
LIGHT_TIERS = ((90000, 90), (70000, 75), (50000, 55))  # R1, at least
HUMIDITY_TIERS = ((25, 85), (35, 65))  # R2, below
RISE_TIERS = ((4, 80), (2.5, 55))  # R3, at least
SOIL_TIERS = ((15, 75), (25, 55))  # R4, below
PERSIST_COUNT, PERSIST_SCORE = 3, 70  # R5, at least
FALLBACK_SCORE = 30  # R6

STRONG_LIGHT = "正午日照过强"
MILD_LIGHT = "日照偏强"
DRY_AIR = "通风系统故障（空气干燥）"
FAST_RISE = "温度飙升过快（Δ%.1f℃/5s）"
QUICK_RISE = "升温较快（Δ%.1f℃/5s）"
DRY_SOIL = "土壤严重缺水"
PERSISTENT = "高温已持续"
MIXED = "多因素综合作用"

STRONG_LIGHT_DETAIL = "同窗口光照 %.0f lux（阈值 70000），太阳辐射强可能导致温室快速升温，建议检查遮阳网是否启动"
MILD_LIGHT_DETAIL = "同窗口光照 %.0f lux，适度阳光也可能在通风差时造成累积升温"
DRY_AIR_DETAIL = "同窗口空气湿度仅 %.1f%%（阈值 35%%），高温叠加干燥通常意味着通风口关闭或风机故障"
FAST_RISE_DETAIL = "近 5 秒内温度骤升 %.1f℃，可能是保温幕未及时拉开或供暖系统未关闭"
QUICK_RISE_DETAIL = "温度 5 秒内上升 %.1f℃，属于偏快水平，建议关注"
DRY_SOIL_DETAIL = "同窗口土壤湿度仅 %.1f%%，缺水导致作物蒸腾降温作用丧失，温度加速攀升"
PERSISTENT_DETAIL = "该大棚近 60 秒内有 %d 个窗口温度超 30℃，属于持续性高温"
MIXED_DETAIL = "当前数据不足以判定单一原因，可能是日照、通风、土壤水分等多个因素共同作用"

EXPORT_HEADER = (
    "大棚",
    "窗口开始",
    "窗口结束",
    "平均温度(℃)",
    "平均空气湿度(%)",
    "平均土壤湿度(%)",
    "最大光照(lux)",
)

COMPARE_HEADER = (
    "大棚",
    "窗口开始",
    "窗口结束",
    "Spark均温(℃)",
    "Flink均温(℃)",
    "温度偏差(℃)",
    "Spark空气湿度(%)",
    "Flink空气湿度(%)",
    "湿度偏差(%)",
    "Spark土壤湿度(%)",
    "Flink土壤湿度(%)",
    "土壤湿度偏差(%)",
    "Spark最大光照(lux)",
    "Flink最大光照(lux)",
    "光照偏差(lux)",
)

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# every white-space character of the basic plane
BLANKS = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())
