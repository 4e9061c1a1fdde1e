"""Small reference tables. Their sizes are fixed, so joins may broadcast them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Month, day, reason, level, impact in days.
PEAK_DAYS = (
    (1, 1, "Tet Nguyen Dan", 3, 14),
    (1, 2, "Tet Nguyen Dan", 3, 14),
    (1, 3, "Tet Nguyen Dan", 3, 14),
    (2, 14, "Valentine", 1, 1),
    (3, 8, "Quoc te Nu", 1, 1),
    (4, 30, "Gio To", 2, 7),
    (5, 1, "Quoc te Lao dong", 2, 7),
    (6, 1, "Quoc te Thieu nhi", 1, 1),
    (7, 1, "Cao diem he", 2, 7),
    (8, 15, "Back to school", 2, 7),
    (9, 2, "Thu sang", 2, 7),
    (10, 20, "Cuoi nam", 2, 7),
    (11, 11, "Black Friday", 1, 1),
    (11, 29, "Sale cuoi nam", 2, 7),
    (12, 24, "Giang sinh", 2, 7),
    (12, 25, "Giang sinh", 1, 1),
    (12, 31, "Countdown", 1, 1),
)

# Month, season, reason.
MONTH_SEASONS = (
    (1, "Winter", "Tet Nguyen Dan"),
    (2, "Winter", "Sau Tet"),
    (3, "Spring", "Mua xuan"),
    (4, "Spring", "Gio To"),
    (5, "Spring", "Mua cuoi"),
    (6, "Summer", "Mua he"),
    (7, "Summer", "Cao diem he"),
    (8, "Summer", "Back to school"),
    (9, "Autumn", "Thu sang"),
    (10, "Autumn", "Cuoi nam"),
    (11, "Autumn", "Black Friday"),
    (12, "Winter", "Giang sinh va nam moi"),
)

# Store type codes, names, usual area and customers.
STORE_TYPES = (
    ("KPDT", "UP", "Cửa hàng khu phố đô thị", "Urban Street Store",
     "Cửa hàng trên đường phố khu đông dân cư đô thị", "50-200", "Khách đi bộ + xe máy"),
    ("KCC", "AP", "Cửa hàng khu chung cư", "Apartment Complex Store",
     "Cửa hàng trong hoặc gần khu chung cư căn hộ", "30-100", "Cư dân chung cư"),
    ("KCN", "IZ", "Cửa hàng khu công nghiệp", "Industrial Zone Store",
     "Cửa hàng phục vụ công nhân trong/gần KCN", "80-300", "Công nhân KCN"),
    ("CTT", "TM", "Cửa hàng chợ truyền thống", "Traditional Market Store",
     "Cửa hàng trong chợ truyền thống", "15-50", "Ngườ i mua sắm chợ"),
    ("KVNT", "RL", "Cửa hàng khu vực nông thôn", "Rural Area Store",
     "Cửa hàng ở xã huyện vùng nông thôn", "40-150", "Ngườ i dân địa phương"),
)


def peak_days(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(PEAK_DAYS),
        "month int, day int, peak_reason string, peak_level int, impact_days int",
    )


def seasons(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(MONTH_SEASONS), "month int, season string, peak_reason string"
    )


def store_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(STORE_TYPES),
        "type_code string, type_code_2 string, type_name_vn string, type_name_en string, "
        "description string, typical_area_m2 string, target_customer string",
    )
