"""SQL views in the shape of the pipeline's inputs, and helpers to write oracle queries.

Written for a plain SQL engine and independent of the Spark plans: medians are medians, self-joins stay self-joins.
"""

from __future__ import annotations

import re

TARGETS = ["Dry_Clover_g", "Dry_Dead_g", "Dry_Green_g", "Dry_Total_g", "GDM_g"]


def r(expression: str, name: str, digits: int = 6) -> str:
    """Rounded column; adding zero turns a negative zero into zero."""
    return f"round({expression}, {digits}) + 0.0 AS {name}"


VIEWS = {
    "folds": "SELECT CAST(range AS INTEGER) AS k FROM range(5)",
    "observed": """
        SELECT 'train/' || l_orderkey || '.jpg' AS image_path,
               CASE l_returnflag WHEN 'A' THEN 'Dry_Clover_g' WHEN 'N' THEN 'Dry_Dead_g' ELSE 'Dry_Green_g' END AS target_name,
               sum(l_quantity) AS target
        FROM lineitem GROUP BY ALL""",
    "targets_wide": """
        SELECT 'train/' || l_orderkey || '.jpg' AS image_path,
               sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS Dry_Clover_g,
               sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS Dry_Dead_g,
               sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS Dry_Green_g,
               sum(l_quantity) AS Dry_Total_g,
               sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity ELSE 0 END) AS GDM_g
        FROM lineitem GROUP BY 1""",
    "targets_long": "UNPIVOT targets_wide ON " + ", ".join(TARGETS) + " INTO NAME target VALUE y",
    "samples": """
        SELECT 'train/' || o_orderkey || '.jpg' AS image_path, o_custkey AS group_id,
               CAST(o_custkey % 5 AS INTEGER) AS fold,
               CASE WHEN o_orderkey % 17 <> 0 THEN c_mktsegment END AS State,
               CASE WHEN o_orderkey % 19 <> 0 THEN n_name END AS Species,
               CASE WHEN o_orderkey % 13 <> 0 THEN c_acctbal END AS Pre_GSHH_NDVI,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS Height_Ave_cm
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "modelling": "SELECT * FROM samples JOIN targets_wide USING (image_path)",
    "images": "SELECT 'train/' || vec_id || '.jpg' AS image_path, embedding, label FROM embeddings",
    "cells": "SELECT image_path, CAST(p AS INTEGER) AS p, CAST(embedding[p + 1] AS DOUBLE) AS e FROM images, range(64) t(p)",
    "channel": "SELECT image_path, p, CAST(floor(least(greatest((e + 0.5) * 255.0, 0.0), 255.0)) AS INTEGER) AS c FROM cells",
    "pixels": """
        SELECT a.image_path, CAST(a.p // 8 AS INTEGER) AS y, CAST(a.p % 8 AS INTEGER) AS x, a.c AS r, b.c AS g, d.c AS b
        FROM channel a JOIN channel b ON a.image_path = b.image_path AND b.p = (a.p + 21) % 64
        JOIN channel d ON a.image_path = d.image_path AND d.p = (a.p + 42) % 64""",
    "spread": "SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS diff FROM pixels",
    "hue": """
        SELECT *, CASE WHEN v = 0 THEN 0 ELSE floor((diff * round_even(255.0 * 4096 / v, 0) + 2048) / 4096.0) END AS s0,
               CASE WHEN diff = 0 THEN 0
                    ELSE floor((CASE WHEN v = r THEN g - b WHEN v = g THEN b - r + 2 * diff ELSE r - g + 4 * diff END
                                * round_even(180.0 * 4096 / (6.0 * diff), 0) + 2048) / 4096.0) END AS h0
        FROM spread""",
    "hsv": """
        SELECT image_path, y, x, r, g, b, CAST(CASE WHEN h0 < 0 THEN h0 + 180 ELSE h0 END AS INTEGER) AS h,
               CAST(s0 AS INTEGER) AS s, v,
               CASE WHEN r + g + b = 0 THEN 0.0
                    ELSE 2.0 * (g::DOUBLE / (r + g + b)) - (r::DOUBLE / (r + g + b)) - (b::DOUBLE / (r + g + b)) END AS exg
        FROM hue""",
    "bands": """
        SELECT *, exg > 0 AS veg, h BETWEEN 5 AND 35 AND s BETWEEN 30 AND 180 AND v >= 60 AS brown FROM hsv""",
    "grey": "SELECT image_path, y, x, (r * 9798 + g * 19235 + b * 3735 + 16384) // 32768 AS grey FROM pixels",
    "levels": "SELECT image_path, y, x, CAST(floor(grey / 255.0 * 31.0) AS INTEGER) AS lv FROM grey",
    # Symmetric pairs, both ways round, for distances 1, 3 and 5 along a row.
    "pairs": """
        SELECT a.image_path, d.d, a.lv AS i, b.lv AS j FROM levels a, (VALUES (1), (3), (5)) d(d), levels b
        WHERE a.image_path = b.image_path AND a.y = b.y AND b.x = a.x + d.d
        UNION ALL
        SELECT a.image_path, d.d, b.lv AS i, a.lv AS j FROM levels a, (VALUES (1), (3), (5)) d(d), levels b
        WHERE a.image_path = b.image_path AND a.y = b.y AND b.x = a.x + d.d""",
    "glcm": """
        SELECT image_path, d, i, j, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY image_path, d) AS p
        FROM pairs GROUP BY image_path, d, i, j""",
    "glcm_mean": """
        SELECT image_path, d, sum(p * i) AS mi, sum(p * j) AS mj FROM glcm GROUP BY image_path, d""",
    "glcm_moment": """
        SELECT g.image_path, g.d, sum(p * (i - mi) * (i - mi)) AS vi, sum(p * (j - mj) * (j - mj)) AS vj,
               sum(p * (i - mi) * (j - mj)) AS cij,
               sum(p * (i - j) * (i - j)) AS contrast, sum(p * abs(i - j)) AS dissimilarity,
               sum(p / (1.0 + (i - j) * (i - j))) AS homogeneity, sqrt(sum(p * p)) AS energy
        FROM glcm g JOIN glcm_mean m ON g.image_path = m.image_path AND g.d = m.d GROUP BY g.image_path, g.d""",
    "texture": """
        SELECT image_path, avg(contrast) AS texture_contrast, avg(dissimilarity) AS texture_dissimilarity,
               avg(homogeneity) AS texture_homogeneity, avg(energy) AS texture_energy,
               avg(CASE WHEN sqrt(vi) < 1e-7 THEN 1.0 ELSE cij / sqrt(vi * vj) END) AS texture_correlation
        FROM glcm_moment GROUP BY image_path""",
    # Edges: every pixel sees its 3 x 3 neighbourhood by position, with repeated borders.
    "sobel": """
        SELECT c.image_path, c.y, c.x, sum(n.grey * o.wx)::INTEGER AS gx, sum(n.grey * o.wy)::INTEGER AS gy
        FROM grey c,
             (VALUES (-1,-1,-1,-1), (-1,0,0,-2), (-1,1,1,-1), (0,-1,-2,0), (0,1,2,0), (1,-1,-1,1), (1,0,0,2), (1,1,1,1)) o(dy,dx,wx,wy),
             grey n
        WHERE n.image_path = c.image_path AND n.y = least(greatest(c.y + o.dy, 0), 7) AND n.x = least(greatest(c.x + o.dx, 0), 7)
        GROUP BY c.image_path, c.y, c.x""",
    "magnitudes": "SELECT *, abs(gx) + abs(gy) AS m FROM sobel",
    "sectors": """
        SELECT *, CASE WHEN abs(gy)::BIGINT * 32768 < abs(gx)::BIGINT * 13573 THEN 'flat'
                       WHEN abs(gy)::BIGINT * 32768 > abs(gx)::BIGINT * 13573 + abs(gx)::BIGINT * 65536 THEN 'steep'
                       WHEN (gx < 0) <> (gy < 0) THEN 'falling' ELSE 'rising' END AS sector FROM magnitudes""",
    "neighbours": """
        SELECT s.*, coalesce(p.m, 0) AS before_m, coalesce(n.m, 0) AS after_m
        FROM sectors s
        JOIN (VALUES ('flat', 0, 1), ('steep', 1, 0), ('falling', 1, -1), ('rising', 1, 1)) o(sector, dy, dx) ON o.sector = s.sector
        LEFT JOIN magnitudes p ON p.image_path = s.image_path AND p.y = s.y - o.dy AND p.x = s.x - o.dx
        LEFT JOIN magnitudes n ON n.image_path = s.image_path AND n.y = s.y + o.dy AND n.x = s.x + o.dx""",
    "candidates": """
        SELECT image_path, y, x, m > 150 AS strong FROM neighbours
        WHERE m > 50 AND m > before_m AND (m > after_m OR (m = after_m AND sector IN ('flat', 'steep')))""",
    "edges": """
        SELECT image_path, y, x FROM candidates WHERE strong
        UNION
        SELECT c.image_path, c.y, c.x FROM edges e JOIN candidates c
          ON c.image_path = e.image_path AND abs(c.y - e.y) <= 1 AND abs(c.x - e.x) <= 1""",
    "edge_share": """
        SELECT p.image_path, coalesce(e.n, 0)::DOUBLE / p.n AS edge_density
        FROM (SELECT image_path, count(*) AS n FROM pixels GROUP BY 1) p
        LEFT JOIN (SELECT image_path, count(*) AS n FROM edges GROUP BY 1) e ON p.image_path = e.image_path""",
    "monitor": """
        SELECT event_id AS token, ts, event_type AS State, CAST(user_id AS VARCHAR) AS Species, value AS Dry_Total_g,
               CAST(1 + user_id % 4 AS DOUBLE) AS area_m2 FROM events""",
    "medians": """
        SELECT k, median(Pre_GSHH_NDVI) AS med_n, median(Height_Ave_cm) AS med_h
        FROM folds JOIN samples ON fold <> k GROUP BY k""",
    "scales": """
        SELECT k, any_value(med_n) AS med_n, any_value(med_h) AS med_h,
               avg(coalesce(Pre_GSHH_NDVI, med_n)) AS mean_n, stddev_pop(coalesce(Pre_GSHH_NDVI, med_n)) AS std_n,
               avg(coalesce(Height_Ave_cm, med_h)) AS mean_h, stddev_pop(coalesce(Height_Ave_cm, med_h)) AS std_h
        FROM medians JOIN samples ON fold <> k GROUP BY k""",
    "category_counts": """
        SELECT k, 'State' AS "column", State AS category, count(*) AS n FROM folds JOIN samples ON fold <> k
        WHERE State IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT k, 'Species', Species, count(*) FROM folds JOIN samples ON fold <> k WHERE Species IS NOT NULL GROUP BY ALL""",
    "modes": """
        SELECT k, "column", category AS mode FROM category_counts
        QUALIFY row_number() OVER (PARTITION BY k, "column" ORDER BY n DESC, category) = 1""",
    "mode_wide": """
        SELECT k, max(CASE WHEN "column" = 'State' THEN mode END) AS mode_state,
               max(CASE WHEN "column" = 'Species' THEN mode END) AS mode_species FROM modes GROUP BY k""",
    "scaled": """
        SELECT image_path, fold, (coalesce(Pre_GSHH_NDVI, med_n) - mean_n) / std_n AS z_n,
               (coalesce(Height_Ave_cm, med_h) - mean_h) / std_h AS z_h
        FROM samples JOIN scales ON fold = k""",
    "design": """
        SELECT image_path, fold, 'NDVI' AS feature_set, z_n AS z, target, y FROM scaled JOIN targets_long USING (image_path)
        UNION ALL
        SELECT image_path, fold, 'Height', z_h, target, y FROM scaled JOIN targets_long USING (image_path)""",
    "sums": """
        SELECT k, feature_set, target, avg(z) AS mx, avg(y) AS my, count(*) * var_pop(z) AS sxx, count(*) * covar_pop(y, z) AS sxy
        FROM folds JOIN design ON fold <> k GROUP BY k, feature_set, target""",
    "penalties": "SELECT * FROM (VALUES ('Ridge', 1.0::DOUBLE), ('Ridge_strong', 1000.0::DOUBLE)) t(model, alpha)",
    "fits": """
        SELECT k, model, feature_set, target, sxy / (sxx + alpha) AS slope, my - sxy / (sxx + alpha) * mx AS intercept
        FROM sums, penalties""",
    "oof": """
        SELECT model, feature_set, fold, image_path, target, y,
               CASE WHEN slope * z + intercept < 0 THEN 0.0 ELSE slope * z + intercept END AS pred
        FROM design JOIN fits USING (feature_set, target) WHERE fold = k""",
    "fold_metrics": """
        SELECT model, feature_set, fold, target, avg(abs(y - pred)) AS MAE, sqrt(avg((y - pred) * (y - pred))) AS RMSE,
               1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y)) AS R2
        FROM oof GROUP BY model, feature_set, fold, target""",
    "cv_summary": """
        SELECT model, feature_set, target, avg(MAE) AS MAE_mean, stddev_samp(MAE) AS MAE_std, avg(RMSE) AS RMSE_mean,
               stddev_samp(RMSE) AS RMSE_std, avg(R2) AS R2_mean, stddev_samp(R2) AS R2_std
        FROM fold_metrics GROUP BY model, feature_set, target""",
    "config_means": """
        SELECT model, feature_set, avg(MAE_mean) AS mean_MAE, avg(RMSE_mean) AS mean_RMSE, avg(R2_mean) AS mean_R2
        FROM cv_summary GROUP BY model, feature_set""",
    "ranking": """
        SELECT row_number() OVER (ORDER BY mean_RMSE, mean_MAE, model, feature_set) AS rank, * FROM config_means""",
    "best": """
        SELECT * FROM cv_summary
        QUALIFY row_number() OVER (PARTITION BY target ORDER BY RMSE_mean, model, feature_set) = 1""",
    "two": """
        SELECT a.image_path, a.target, a.y, a.pred AS a, b.pred AS b
        FROM (SELECT * FROM oof WHERE model = 'Ridge' AND feature_set = 'NDVI') a
        JOIN (SELECT * FROM oof WHERE model = 'Ridge' AND feature_set = 'Height') b USING (image_path, target)""",
}

_NAME = re.compile(r"[A-Za-z_]\w*")


def sql(body: str) -> str:
    """The query with every view it names, directly or through other views, in front."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(_NAME.findall(text)):
            if name in VIEWS and name not in needed:
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed)
    # Only the linking of edges needs recursion.
    kind = "WITH RECURSIVE" if "edges" in needed else "WITH"
    return f"{kind} {views}\n{body.strip()}" if views else body.strip()
