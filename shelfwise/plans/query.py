"""Query registry.

A query is a Spark function of `Sources` plus, where SQL can say it, the same answer in
SQL over the raw tables. Doubles are rounded the same way on both sides, because sums of
doubles depend on the order of the partial sums.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.canonical import Sources

# Moves exact half-way values (a mean of prices, say) off the tie before rounding.
OFF_TIE = 0.0000013


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[Sources], DataFrame]
    sql: str | None
    two: tuple[str, ...]
    four: tuple[str, ...]

    def frame(self, spark, folder: str) -> DataFrame:
        df = self.run(Sources(spark, folder))
        rounded = {c: F.rint(F.col(c) * 100.0) / 100.0 for c in self.two}
        rounded |= {c: F.rint((F.col(c) + OFF_TIE) * 10000.0) / 10000.0 for c in self.four}
        return df.withColumns(rounded) if rounded else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        swaps = [f"round(CAST({c} AS DOUBLE) * 100) / 100 AS {c}" for c in self.two]
        swaps += [
            f"round((CAST({c} AS DOUBLE) + CAST({OFF_TIE:.7f} AS DOUBLE)) * 10000) / 10000 AS {c}" for c in self.four
        ]
        tail = f" REPLACE ({', '.join(swaps)})" if swaps else ""
        return f"WITH {BASE}, {self.sql.strip()}\nSELECT *{tail} FROM answer"


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None, two: str = "", four: str = ""):
    """Register a query under `name`; `covers` lists the operator ids it shows."""

    def register(run):
        REGISTRY[name] = Query(
            name, tuple(covers.split()), run, sql, tuple(two.split()), tuple(four.split())
        )
        return run

    return register


# The canonical sources as SQL over the raw tables.
BASE = """
newest AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders),
branches AS (
  SELECT n_name AS ma_chi_nhanh, n_name AS ten_chi_nhanh, r_name AS city,
         ['KPDT','KCC','KCN','CTT','KVNT'][r_regionkey + 1] AS store_type_code
  FROM nation JOIN region ON n_regionkey = r_regionkey),
products AS (
  SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS ma_hang,
         'BC' || CAST(p_partkey AS VARCHAR) AS ma_vach, p_name AS ten_hang,
         p_brand AS thuong_hieu, p_type AS cap_1, p_brand AS cap_2, '' AS cap_3,
         p_retailprice AS gia_ban_mac_dinh, round(p_retailprice * CAST(0.7 AS DOUBLE), 2) AS gia_von_mac_dinh,
         p_size AS quy_doi, p_size AS ton_nho_nhat
  FROM part),
tx AS (
  SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS ma_giao_dich,
         CAST(o_orderdate AS DATE) AS ngay, n_name AS ma_chi_nhanh, n_name AS ten_chi_nhanh,
         o_custkey AS ma_khach
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
de AS (
  SELECT l_orderkey AS transaction_id, CAST(l_partkey AS VARCHAR) AS ma_hang, l_quantity AS so_luong,
         l_extendedprice / l_quantity AS don_gia, l_extendedprice * l_discount AS chiet_khau,
         l_extendedprice * l_tax AS thue_gtgt, l_extendedprice AS thanh_tien
  FROM lineitem),
lines AS (
  SELECT t.id AS transaction_id, t.ngay, t.ma_chi_nhanh, t.ma_khach, d.ma_hang, d.so_luong, d.don_gia,
         d.chiet_khau, d.thanh_tien, p.ten_hang, p.thuong_hieu, p.cap_1, p.cap_2, p.cap_3,
         p.gia_von_mac_dinh AS gia_von, d.so_luong * coalesce(p.gia_von_mac_dinh, d.don_gia * CAST(0.7 AS DOUBLE)) AS von
  FROM de d JOIN tx t ON d.transaction_id = t.id LEFT JOIN products p ON d.ma_hang = p.ma_hang),
daily AS (
  SELECT ngay AS transaction_date, ma_hang AS product_code, ma_chi_nhanh AS branch_code,
         any_value(cap_1) AS cap_1, any_value(cap_2) AS cap_2, any_value(thuong_hieu) AS brand,
         count(*) AS line_count, sum(so_luong) AS quantity_sold, sum(thanh_tien) AS gross_revenue,
         sum(don_gia) AS price_sum, sum(von) AS cost
  FROM lines GROUP BY 1, 2, 3),
regular AS (SELECT * FROM daily WHERE coalesce(cap_1, '') NOT LIKE '%PROMO%'),
stock AS (
  SELECT ma_hang, 'BC' || ma_hang AS ma_vach, chi_nhanh, closing - spare AS ton_dau_ky,
         sl_xuat + spare AS sl_nhap, sl_xuat, closing AS ton_cuoi_ky, snapshot_date
  FROM (SELECT *, sum(spare) OVER (PARTITION BY ma_hang, chi_nhanh ORDER BY snapshot_date
                                   ROWS UNBOUNDED PRECEDING) AS closing
        FROM (SELECT ma_hang, ma_chi_nhanh AS chi_nhanh, last_day(ngay) AS snapshot_date,
                     sum(so_luong) AS sl_xuat,
                     CAST(any_value(CAST(ma_hang AS BIGINT) % 7) AS DOUBLE) AS spare
              FROM lines GROUP BY 1, 2, 3)))
"""

# Category patterns that stand for promotions in the test tables.
PROMO = ("%promo%",)
