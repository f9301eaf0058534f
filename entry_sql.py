"""The registered queries as SQL on the driver tables, for comparison."""

from __future__ import annotations

from entry_views import LAYOUT, LOW_SETTINGS, REPEATED_TYPES, SETTINGS
from packshot.operators.attributes import PRIMARY_IMAGE
from packshot.sources.layouts import ImageSettings

LAYOUT_ROWS = ", ".join(f"({i}, '{t}', {ulx}::double, {uly}::double, {w}::double)" for i, (t, ulx, uly, w) in enumerate(LAYOUT))

# name -> body; each may use the ones before it
CTES = {
    "layout(pos, product_type, ulx, uly, w)": f"values {LAYOUT_ROWS}",
    "repeated(pos, product_type)": "values " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(REPEATED_TYPES)),
    "b": """
        select l_orderkey || '-' || (l_linenumber // 32) as line_key,
               row_number() over (partition by l_orderkey, l_linenumber // 32
                   order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, p_type, p_brand) - 1 as pos,
               l_partkey::varchar as oms_id, p_type as product_type, p_brand
        from lineitem join part on l_partkey = p_partkey""",
    "kept": """
        select * from (select *, row_number() over (partition by line_key, product_type order by pos) as rn from b)
        where rn = 1""",
    "attributes": f"""
        select p_partkey::varchar as oms_id, u.attribute_id, u.attribute_value
        from part,
             unnest([{{'attribute_id': 'p_name', 'attribute_value': p_name}},
                     {{'attribute_id': 'p_brand', 'attribute_value': p_brand}},
                     {{'attribute_id': 'p_type', 'attribute_value': p_type}},
                     {{'attribute_id': '{PRIMARY_IMAGE}', 'attribute_value': p_brand || '-' || p_partkey}}]) t(u)""",
    "sku_images": f"""
        select distinct on (oms_id, img_guid, product_type) oms_id, attribute_value as img_guid, product_type
        from attributes join (select distinct oms_id, product_type from b) using (oms_id)
        where attribute_id = '{PRIMARY_IMAGE}'""",
}


def _sets(source: str, layout: str = "layout") -> dict[str, str]:
    """Product sets of a product table, by counting which set takes which product."""
    return {
        "placed": f"""
            select line_key, l.pos as layer, product_type, oms_id,
                   row_number() over (partition by line_key, l.pos order by s.pos) - 1 as r
            from {source} s join {layout} l using (product_type)""",
        "groups": "select line_key, layer, count(*) as n from placed group by all",
        "strides": """
            select line_key, layer, n,
                   coalesce(product(n) over (partition by line_key order by layer
                       rows between unbounded preceding and 1 preceding), 1)::bigint as stride
            from groups""",
        "numbers": f"""
            select line_key, unnest(range(coalesce(p, 1)::bigint)) as i
            from (select distinct line_key from {source})
            left join (select line_key, product(n)::bigint as p from groups group by 1) using (line_key)""",
        "members": """
            select line_key, i, layer, product_type, oms_id
            from numbers join strides using (line_key) join placed using (line_key, layer)
            where r = (i // stride) % n""",
        "sets": """
            select n.line_key, n.line_key || '_' || n.i as img_id,
                   coalesce(string_agg(m.oms_id, ',' order by m.layer), '') as sku_list
            from numbers n left join members m on n.line_key = m.line_key and n.i = m.i
            group by n.line_key, n.i""",
    }


LAYOUTS = {
    "counted": "select p_brand, p_size, p_type, count(*) as n, min(p_partkey) as k from part group by all",
    "firsts": """
        select p_brand || '/' || (p_size % 5) as bundle_type, p_brand, min(p_size) as p_size
        from part group by p_brand, p_size % 5""",
    "typed": """
        select bundle_type, p_type, n, k, row_number() over (partition by bundle_type order by p_type) - 1 as i,
               count(*) over (partition by bundle_type) as m
        from firsts join counted using (p_brand, p_size)""",
    "layers": """
        select bundle_type, i + m * again as pos, p_type as product_type,
               ('0.' || lpad(((n + 7 * again) % 100)::varchar, 2, '0'))::double as ulx,
               ('0.' || lpad(((k + 7 * again) % 100)::varchar, 2, '0'))::double as uly,
               ('0.' || lpad(((n + k + 7 * again) % 100)::varchar, 2, '0'))::double as w
        from typed, (values (0), (1)) t(again)""",
}

RASTER = {
    "red": """
        select vec_id as image_id, i,
               least(255, greatest(0, floor(255 * (embedding[i + 1]::double * 2 + 0.8))))::int as r
        from embeddings, range(64) t(i)""",
    "raster": """
        select image_id, (i % 8)::int as x, (i // 8)::int as y, r,
               (255 - (255 - r) * 3 // 4)::int as g, (255 - (255 - r) // 2)::int as b, 255::int as a
        from red""",
    "gray": "select *, (2125 * r + 7154 * g + 721 * b)::int as luma from raster",
}


def _regions(mask: str) -> dict[str, str]:
    """Region of every pixel of the mask table ``(image_id, mask, x, y)``, by following neighbours."""
    return {
        "m": f"select image_id, mask, x, y, y::bigint * 4294967296 + x as own from ({mask})",
        "reach": """
            select image_id, mask, x, y, own as region from m
            union
            select m.image_id, m.mask, m.x, m.y, r.region
            from reach r, (values (0, 1), (0, -1), (1, 0), (-1, 0)) d(dx, dy), m
            where m.image_id = r.image_id and m.mask = r.mask and m.x = r.x + dx and m.y = r.y + dy
              and r.region < m.own""",
        "labelled": "select image_id, mask, x, y, min(region) as region from reach group by all",
        "sized": "select *, count(*) over (partition by image_id, mask, region) as size from labelled",
    }


NON_WHITE = "select image_id, 0 as mask, x, y from gray where luma <= 2422500"



def _cutoffs(settings: ImageSettings) -> dict[str, str]:
    """The gray cutoff of every image, from all masks of its levels and the white one."""
    first = round(settings.silo_gray_max_cutoff * 100)
    top = 100 - first
    return {
        **RASTER,
        **_regions(f"""
            select image_id, k as mask, x, y from gray, range({top + 1}) t(k) where luma <= ({first} + k) * 25500
            union all select image_id, {top + 1}, x, y from gray where luma >= 2550000"""),
        "totals": "select image_id, count(*) as n_pixels from raster group by 1",
        "big": f"""
            select * from sized join totals using (image_id) where size > n_pixels * {settings.silo_filter_size_cutoff}::double""",
        "shares": f"""
            select image_id, n_pixels, mask, count(*) as covered from big where mask <= {top} group by all
            having count(*) > n_pixels * {settings.silo_min_img_not_background}::double""",
        "cutoffs": f"""
            select image_id, n_pixels, min(mask)::bigint as level, (({first} + min(mask)) * 25500)::bigint as cutoff,
                   arg_min(covered, mask) as covered
            from shares group by image_id, n_pixels""",
    }


SILHOUETTE = {
    **_cutoffs(SETTINGS),
    "seeds": """
        select image_id, x, y, sum(case mask when 6 then 1 else 2 end)::int as seed
        from big join (select image_id, level from cutoffs) using (image_id)
        where mask in (level, 6) group by image_id, x, y""",
    "cutouts": "select image_id, x, y, r, g, b from raster join (select * from seeds where seed = 2) using (image_id, x, y)",
    "bbox": f"""
        select image_id, min(x) + {SETTINGS.erode_size} as min_x, max(x) - {SETTINGS.erode_size} as max_x,
               min(y) + {SETTINGS.erode_size} as min_y, max(y) - {SETTINGS.erode_size} as max_y
        from cutouts group by 1""",
}

CANVAS = SETTINGS.canvas
FLOOR = CANVAS - SETTINGS.bottom_border

LAYERS = {
    **CTES,
    **SILHOUETTE,
    "placed_skus": """
        select oms_id, product_type, min(regexp_extract(img_guid, '([0-9]+)$', 1)::bigint) as image_id
        from sku_images group by all""",
    "boxes": f"""
        select *, max_x - min_x as dx, max_y - min_y as dy, trunc({CANVAS} * ulx)::int as "left",
               trunc({CANVAS} * uly)::int as top, trunc({CANVAS} * w)::int as width
        from placed_skus join layout using (product_type) join bbox using (image_id)""",
    "placement": f"""
        select *, case when dx <> 0 and dy::double * width / dx + top > {FLOOR}
                       then ({FLOOR} - top)::double / nullif(dy, 0) else width::double / nullif(dx, 0) end as scale
        from boxes""",
    "outs": """
        select *, dx + 1 as sw, dy + 1 as sh, round_even((dx + 1) * scale, 0)::bigint as ow,
               round_even((dy + 1) * scale, 0)::bigint as oh
        from placement where scale is not null""",
    # every target pixel looks its source pixel up
    "grid": """
        select oms_id, product_type, image_id, "left" + tx as x, top + ty as y,
               min_x + ((2 * tx + 1) * sw) // (2 * ow) as sx, min_y + ((2 * ty + 1) * sh) // (2 * oh) as sy
        from (select *, unnest(range(ow)) as tx from outs where ow > 0 and oh > 0 and sw > 0 and sh > 0),
             lateral (select unnest(range(oh)) as ty)""",
    "layer_raster": f"""
        select g.oms_id, g.product_type, g.x::int as x, g.y::int as y, c.r, c.g, c.b, 255::int as a
        from grid g join cutouts c on c.image_id = g.image_id and c.x = g.sx and c.y = g.sy
        where g.x between 0 and {CANVAS - 1} and g.y between 0 and {CANVAS - 1}""",
}

PICTURES = {
    **LAYERS,
    **_sets("b"),
    "stacks": """
        select line_key || '_' || i as img_id, layer, l.x, l.y, l.r, l.g, l.b
        from members m join layer_raster l using (oms_id, product_type)""",
}

COMPOSITE = {
    **PICTURES,
    "cells": """
        select img_id, x, y, list({'r': r, 'g': g, 'b': b, 'a': (r * 7 + x * 31 + y * 17) % 256} order by layer) as c
        from stacks group by all""",
    "folded": """
        select img_id, x, y, list_reduce(c, lambda d, p: {
            'r': (p.r * p.a + d.r * (255 - p.a) + 127) // 255, 'g': (p.g * p.a + d.g * (255 - p.a) + 127) // 255,
            'b': (p.b * p.a + d.b * (255 - p.a) + 127) // 255, 'a': p.a}, {'r': 255, 'g': 255, 'b': 255, 'a': 255}) as o
        from cells""",
}

BUNDLE_PIXELS = {
    **PICTURES,
    "bundle_pixels": """
        select img_id, x, y, arg_max(r, layer) as r, arg_max(g, layer) as g, arg_max(b, layer) as b
        from (select * from stacks
              union all select line_key || '_' || i, -1, 0, 0, 255, 255, 255 from numbers)
        group by all""",
}

# whole orders as bundles, however many line numbers they have; lines without a number are in no bundle
WHOLE_BUNDLE_PIXELS = {
    **BUNDLE_PIXELS,
    "b": CTES["b"].replace("l_linenumber // 32", "case when l_linenumber is not null then 0 end"),
}


def _resized(source: str, keys: str, side: int, sizes: tuple[int, ...], channels: str) -> str:
    """Block means over the whole square; missing pixels are white, without alpha."""
    size_rows = ", ".join(f"({s})" for s in sizes)
    sums = ", ".join(f"sum({c}) as {c}" for c in channels)
    means = ", ".join(f"(({c} + (cells - n) * {0 if c == 'a' else 255}) // cells)::int as {c}" for c in channels)
    return f"""
        select {keys}, size::int as size, cx::int as x, cy::int as y, {means}
        from (select {keys}, size, x * size // {side} as cx, y * size // {side} as cy, count(*) as n, {sums}
              from {source}, (values {size_rows}) z(size) group by all)
        join (select size, x * size // {side} as cx, y * size // {side} as cy, count(*) as cells
              from (values {size_rows}) z(size), range({side}) gx(x), range({side}) gy(y) group by all)
        using (size, cx, cy)"""


def _query(ctes: dict[str, str], body: str) -> str:
    kind = "with recursive" if "reach" in ctes else "with"
    return f"{kind} " + ",\n".join(f"{name} as ({sql})" for name, sql in ctes.items()) + "\n" + body


MISSING = {
    "asked": f"""
        select oms_id, product_type, p_partkey as image_id, l.ulx, l.uly, l.w
        from (select distinct oms_id, product_type from b)
        left join (select * from part where p_size <= 40) on p_partkey::varchar = oms_id
        left join layout l using (product_type)""",
    "measured": f"""
        select *, max_x - min_x as dx, max_y - min_y as dy, trunc({CANVAS} * uly)::int as top, trunc({CANVAS} * w)::int as width
        from asked left join (select distinct image_id, true as has_file from raster) using (image_id) left join bbox using (image_id)""",
    "scaled": f"""
        select *, case when dx <> 0 and dy::double * width / dx + top > {FLOOR}
                       then ({FLOOR} - top)::double / nullif(dy, 0) else width::double / nullif(dx, 0) end as scale
        from measured""",
    "reasons": """
        select oms_id, product_type,
               case when ulx is null then 'no place' when image_id is null then 'no image' when has_file is null then 'no file'
                    when min_x is null then 'no foreground'
                    when not coalesce(dx >= 0 and dy >= 0 and round_even((dx + 1) * scale, 0) > 0
                                      and round_even((dy + 1) * scale, 0) > 0, false) then 'no extent' end as reason
        from scaled""",
}

ITEM = """'{"id": "' || oms_id || '", "score": ' || (10000 - pos) || ', "productType": "' || product_type
          || '", "label": "' || p_brand || '"}'"""
BASE_NAME = "regexp_extract(url, '[^/]*$')"
HAS_EXT = r"regexp_matches({n}, '^\.*[^.].*\.[^.]*$')"


def _image_path() -> str:
    return rf"""
        select page_id, f as file, substr(f, 1, 2) || '/' || f as path,
               case when {HAS_EXT.format(n="f")}
                    then regexp_extract(f, '^(.*)\.[^.]*$', 1) || '_65' || regexp_extract(f, '\.[^.]*$')
                    else f || '_65' end as sized
        from (select page_id, case when {HAS_EXT.format(n="n")} then n else n || '.jpg' end as f
              from (select page_id, {BASE_NAME} as n from pages))"""


def oracle_sql() -> dict[str, str]:
    rows = "line_key, pos::bigint as pos, oms_id, product_type"
    sets = {**CTES, **_sets("b")}
    return {
        "bundle_lines": _query(CTES, f"""
            select line_key, '[' || string_agg({ITEM}, ', ' order by pos) || ']' as product_list_json from b group by 1"""),
        "product_rows": _query(CTES, f"select {rows} from b"),
        "first_per_type": _query(CTES, f"select {rows} from kept"),
        "first_per_type_rows": _query(CTES, f"select {rows} from kept"),
        "first_per_type_lists": _query(CTES, f"""
            select line_key, '[' || string_agg(replace(replace({ITEM}, '": ', '":'), ', "', ',"'), ',' order by pos) || ']'
                   as product_list_json
            from kept group by 1"""),
        "product_sets": _query(sets, "select * from sets"),
        "product_sets_repeated_types": _query({**CTES, **_sets("b", "repeated")}, "select * from sets"),
        "product_sets_filtered": _query({**CTES, **_sets("kept")}, "select * from sets"),
        "type_groups": _query(sets, """
            select line_key, layer::bigint as layer, product_type, string_agg(oms_id, ',' order by r) as sku_list
            from placed group by all"""),
        "layer_skus": _query(CTES, "select distinct oms_id, product_type from b"),
        "unplaced_products": _query(CTES, f"""
            select {rows} from b where product_type not in (select product_type from layout)"""),
        "sku_counts": "select l_partkey::varchar as sku, count(*) as n from lineitem group by 1",
        "image_id_mapping": _query(sets, "select line_key, img_id from sets"),
        "attribute_scan": _query(CTES, "select * from attributes"),
        "primary_image": _query(CTES, f"""
            select oms_id, attribute_value as img_guid from attributes where attribute_id = '{PRIMARY_IMAGE}'"""),
        "sku_images": _query(CTES, "select * from sku_images"),
        "skus_missing": """
            select l_partkey::varchar as sku from lineitem
            where l_partkey not in (select p_partkey from part where p_size <= 40)""",
        "layout_layers": _query(LAYOUTS, "select * from layers"),
        "first_layer": _query(LAYOUTS, """
            select bundle_type, product_type, min(pos) as pos, arg_min(ulx, pos) as ulx, arg_min(uly, pos) as uly,
                   arg_min(w, pos) as w
            from layers group by 1, 2"""),
        "sku_layers": _query(CTES, """
            select product_type, oms_id, img_guid, pos::bigint as pos, ulx, uly, w
            from sku_images join layout using (product_type)"""),
        "date_roundtrip": """
            select o_orderkey, case when o_orderkey % 7 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end as dashed,
                   case when o_orderkey % 7 <> 0 then strftime(o_orderdate, '%Y/%m/%d') end as slashed,
                   case when o_orderkey % 7 <> 0 then o_orderdate::date - date '1995-01-01' end::varchar as days
            from orders""",
        "uri_parts": """
            select doc_id, case when doc_id % 5 <> 0 then source end as bucket,
                   case when doc_id % 5 <> 0 then lang || '/' || doc_id end as key
            from documents""",
        "path_fill": """
            select o_orderkey,
                   'feeds/<ENV>/' || o_orderstatus || '/' || d || '/items/' || d || '-*' as dated,
                   'feeds/' || o_orderpriority || '/' || o_orderstatus || '/' || d || '/items/' || d || '-*' as filled
            from (select *, strftime(o_orderdate, '%Y-%m-%d') as d from orders)""",
        "image_path": _image_path(),
        "latest_day": """
            select strftime(max(o_orderdate), '%Y-%m-%d') as day from orders
            where o_orderkey % 10 <> 0 and o_orderdate < date '1998-07-01'""",
        "latest_snapshot": """
            select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as day from orders
            where o_orderdate::date = (select max(o_orderdate::date) from orders
                where o_orderdate::date between date '2001-07-21' and date '2001-08-20')""",
        "image_manifest": _query(sets, f"""
            select kind, image, size::bigint as size,
                   'pictures/2020-10-20/' || kind || '/' || image || '_' || size || '.' || ext as path
            from (select distinct 'layer_imgs' as kind, oms_id || '_' || product_type as image, 'png' as ext from b
                  union all select 'package_imgs', img_id, '{SETTINGS.bundle_image_filetype}' from sets),
                 (values {", ".join(f"({s})" for s in SETTINGS.image_sizes)}) z(size)"""),
        "gray": _query(RASTER, """
            select image_id, x, y, luma, luma >= 2550000 as is_white, luma <= 2422500 as is_non_white from gray"""),
        "regions": _query({**RASTER, **_regions(NON_WHITE)}, """
            select image_id, region, count(*) as size from labelled group by all"""),
        "regions_tiled": _query({**RASTER, **_regions(NON_WHITE)}, """
            select image_id, region, count(*) as size from labelled group by all"""),
        "region_pixels": _query({**RASTER, **_regions(NON_WHITE)}, "select image_id, x, y, region from labelled"),
        "filter_mask": _query({**RASTER, **_regions(NON_WHITE)}, f"""
            select image_id, x, y, region from sized
            join (select image_id, count(*) as n_pixels from raster group by 1) using (image_id)
            where size > n_pixels * {SETTINGS.silo_filter_size_cutoff}::double"""),
        "foreground_cutoff": _query(SILHOUETTE, "select * from cutoffs"),
        "foreground_cutoff_low": _query(_cutoffs(LOW_SETTINGS), "select * from cutoffs"),
        "foreground_cutoff_tiled": _query(SILHOUETTE, "select * from cutoffs"),
        "seeds": _query(SILHOUETTE, "select * from seeds"),
        "seeds_tiled": _query(SILHOUETTE, "select * from seeds"),
        "foreground_of_files": _query(SILHOUETTE, "select * from cutouts"),
        "bbox": _query(SILHOUETTE, "select * from bbox"),
        "placement": _query(LAYERS, """
            select oms_id, product_type, "left", top, width, round(scale, 9) as scale from placement"""),
        "layers_missing": _query({**CTES, **SILHOUETTE, **MISSING}, "select oms_id, product_type, reason from reasons where reason is not null"),
        "layer_raster": _query(LAYERS, "select * from layer_raster"),
        "resized": _query(RASTER, _resized("raster", "image_id", 8, (3, 4, 8), "rgba")),
        "layer_images": _query(LAYERS, _resized("layer_raster", "oms_id, product_type", CANVAS, SETTINGS.image_sizes, "rgba")),
        "composite": _query(COMPOSITE, "select img_id, x, y, o.r::int as r, o.g::int as g, o.b::int as b from folded"),
        "bundle_pixels": _query(BUNDLE_PIXELS, "select * from bundle_pixels"),
        "bundle_images": _query(WHOLE_BUNDLE_PIXELS, _resized("bundle_pixels", "img_id", CANVAS, SETTINGS.image_sizes, "rgb")),
        "image_structs": _query({**RASTER, "small": _resized("raster", "image_id", 8, (3, 4, 8), "rgb")}, """
            select image_id, size as height, size as width, 3::int as "nChannels", 16::int as mode,
                   string_agg(printf('%02X%02X%02X', b, g, r), '' order by y, x) as bytes
            from small group by image_id, size"""),
        "image_unpacked": _query(RASTER, "select image_id::varchar as image_id, x, y, r, g, b, a from raster"),
    }
