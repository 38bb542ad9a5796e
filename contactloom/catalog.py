"""Queries of the scaffolding workloads over the test tables, and their SQL.

The SQL is written apart from the Spark plans: other ways to the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactloom import fixtures as fx
from contactloom.functions.text import resolve_motif, right_trim
from contactloom.operators import contact_map as cm
from contactloom.operators import graph, mismatch, pairs, quadtree, sites, split
from contactloom.session import stage
from contactloom.sources import bam, edges, readers, sinks

MOTIF = "en"
WIDE, NARROW, DEPLETION = 2500, 100, 10000

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------- filter workload
def find_sites(spark, d):
    return sites.find_sites(fx.contigs(spark, d), MOTIF).select("name", "site_ord", "pos")


def _sites(spark, d):
    return sites.find_sites(fx.contigs(spark, d), MOTIF)


def _nodes(spark, d):
    return sites.count_sites(_sites(spark, d))


def site_counts(spark, d):
    return _nodes(spark, d).select("node_id", "name", "site_count", "length")


def site_windows(spark, d):
    return sites.site_windows(_sites(spark, d), _nodes(spark, d), len(MOTIF))


def drop_secondary(spark, d):
    return pairs.drop_secondary(fx.alignments(spark, d))


def filter_mapq(spark, d):
    return pairs.filter_mapq(fx.alignments(spark, d), 40)


def coordinate_sort(spark, d):
    return pairs.coordinate_sort(drop_secondary(spark, d))


def _ref_map(spark, d):
    return pairs.map_refs_to_nodes(fx.references(spark, d), _nodes(spark, d))


def map_refs_to_nodes(spark, d):
    return _ref_map(spark, d).select("ref_id", "ref_name", F.coalesce("node_id", F.lit(-1)).alias("node_id"))


def filter_known_refs(spark, d):
    return pairs.filter_known_refs(pairs.filter_mapq(coordinate_sort(spark, d), 40), _ref_map(spark, d))


def _filtered(spark, d, compared=False):
    """The sorted alignments, the nodes, and the alignments near a site, each made once; where rows are only ``compared``, good ones unsorted."""
    found = stage(_sites(spark, d), "sites")
    nodes = sites.count_sites(found)
    rows = pairs.coordinate_keys(pairs.filter_mapq(drop_secondary(spark, d), 40)) if compared else coordinate_sort(spark, d)
    near = pairs.near_sites(rows if compared else pairs.filter_mapq(rows, 40), pairs.map_refs_to_nodes(fx.references(spark, d), nodes), nodes, lambda own: sites.site_windows(found, own, len(MOTIF)))
    return rows, nodes, near


def near_site_alignments(spark, d):
    return _filtered(spark, d)[2]


def mate_pairs(spark, d):
    return pairs.pair_mates(near_site_alignments(spark, d))


def edge_counts(spark, d):
    """Counts need no numbers of rows, so the alignments are not sorted."""
    return pairs.count_edges(pairs.pair_mates(_filtered(spark, d, compared=True)[2]))


def reduced_alignments(spark, d):
    rows, _, near = _filtered(spark, d)
    return pairs.reduced_alignments(near.select(*rows.columns), pairs.pair_mates(near))


def filter_summary(spark, d):
    rows, nodes, near = _filtered(spark, d)
    return pairs.filter_summary(rows, pairs.reduced_alignments(near, pairs.pair_mates(near)), nodes)


# ------------------------------------------------------------ correct workload
def intra_contacts(spark, d):
    return cm.intra_contacts(fx.mates(spark, d), 1)


def contact_map(spark, d):
    return cm.bin_contacts(intra_contacts(spark, d), WIDE)


def contact_map_narrow(spark, d):
    return cm.bin_contacts(intra_contacts(spark, d), NARROW)


def saturation_level(spark, d):
    return cm.saturation_level(contact_map(spark, d))


def depletion_score(spark, d):
    cells = contact_map(spark, d)
    return cm.depletion_score(cells, cm.saturation_level(cells), WIDE, DEPLETION)


def score_track(spark, d):
    cells = stage(contact_map(spark, d), "map")
    return cm.score_track(cells, cm.saturation_level(cells), WIDE, DEPLETION)


def score_track_narrow(spark, d):
    cells = stage(contact_map_narrow(spark, d), "map")
    return cm.score_track(cells, cm.saturation_level(cells), NARROW, WIDE)


def _islands(coarse):
    coarse = stage(coarse, "wide-map")
    level = cm.saturation_level(coarse)
    track = cm.score_track(coarse, level, WIDE, DEPLETION)
    return mismatch.wide_mismatches(track, cm.threshold_e5(level, WIDE, DEPLETION), WIDE)


def wide_mismatches(spark, d):
    return _islands(contact_map(spark, d))


def narrow_mismatches(spark, d):
    # the raw rows are read once: the wide map is summed up from the fine one
    fine = stage(contact_map_narrow(spark, d), "fine-map")
    track = cm.score_track(fine, cm.saturation_level(fine), NARROW, WIDE)
    return mismatch.narrow_mismatches(_islands(cm.widened(fine, WIDE)), track, NARROW)


def _pieces(spark, d):
    contigs = fx.sequences(spark, d)
    return split.split_contigs(contigs, narrow_mismatches(spark, d).join(contigs.select("ref_id", "name"), "ref_id"))


def corrected_pieces(spark, d):
    return _pieces(spark, d).select("name", "piece_ord", "piece_name", F.length("seq").cast("bigint").alias("length"), F.md5("seq").alias("seq_md5"))


# ---------------------------------------------------------- partition workload
def _graph(spark, d):
    # counts need no numbers of rows, so the alignments are not sorted
    _, nodes, near = _filtered(spark, d, compared=True)
    return nodes, graph.weight_edges(pairs.count_edges(pairs.pair_mates(near)), nodes)


def weighted_edges(spark, d):
    return _graph(spark, d)[1]


def assign_nearest(spark, d):
    return graph.assign_nearest(fx.coordinates(spark, d), fx.centers(spark, d))


def _member_nodes(spark, d):
    """Contigs stand for the vectors with their numbers."""
    return _nodes(spark, d)


def group_contents(spark, d):
    return graph.group_contents(assign_nearest(spark, d), _member_nodes(spark, d))


def group_sizes(spark, d):
    return graph.group_sizes(assign_nearest(spark, d))


def pajek_lines(spark, d):
    return sinks.pajek_lines(*_graph(spark, d)).select("section", "ord", "value")


def kmeans_groups(spark, d):
    return graph.kmeans_groups(fx.coordinates(spark, d), 10)[0]


def layout_cells(spark, d):
    """The tree of cells that a round of the layout goes by, over the coordinates."""
    nodes = fx.coordinates(spark, d).withColumn("mass", F.lit(1.0))
    return quadtree.tree_cells(quadtree.places(nodes, quadtree.square(nodes)[0]), quadtree.LEAF).select("level", "cx", "cy", "n")


def force_layout(spark, d):
    # the stop rule ends it; the bound is for safety only
    return graph.force_layout(*_graph(spark, d), max_iter=10_000)


# ----------------------------------------------------- files written and read again
def _folder(spark, name):
    import uuid

    from contactloom.session import shared_dir

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def enzyme_sites(spark, d):
    """Sites of an enzyme by its name."""
    contigs = fx.sequences(spark, d).select(F.col("ref_id").cast("bigint").alias("contig_ord"), "name", "seq", F.length("seq").cast("bigint").alias("length"))
    found = sites.find_sites(contigs, resolve_motif("MboI"))
    return found.groupBy("name").agg(F.count(F.lit(1)).alias("n_sites"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.sum("pos").alias("sum_pos"))


def fasta_files(spark, d):
    """Contigs as FASTA, sorted by name, and back."""
    path = _folder(spark, "fasta")
    sinks.write_fasta(fx.sequences(spark, d).select("name", F.lit(0).cast("bigint").alias("piece_ord"), "seq"), path, "name")
    return readers.read_fasta(spark, path).select("contig_ord", "name", "length", F.md5("seq").alias("seq_md5"))


#: Bytes of a range and a motif that overlaps itself, so that matches and pieces lie across borders.
RANGE, DOUBLE = 1 << 18, "AA"


def _chunks(spark, d):
    """The sequences as FASTA, read as chunks."""
    path = _folder(spark, "fasta")
    sinks.write_fasta(fx.sequences(spark, d).select("name", F.lit(0).cast("bigint").alias("piece_ord"), F.translate("seq", "C", "A").alias("seq")), path, "name")
    return readers.read_chunks(spark, path, split_bytes=RANGE)


def chunk_sites(spark, d):
    """Sites of a motif that overlaps itself in sequences that are read as chunks."""
    found = sites.find_sites_in_chunks(*_chunks(spark, d), DOUBLE)
    return found.groupBy("name").agg(F.count(F.lit(1)).alias("n_sites"), F.max("site_ord").alias("last_ord"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.sum("pos").alias("sum_pos"), F.sum(F.col("pos") * F.col("site_ord")).alias("sum_product"))


def chunk_pieces(spark, d):
    """Contigs cut at their mismatches, chunk by chunk; the digest alone puts a piece together."""
    contigs, chunks = _chunks(spark, d)
    names = fx.sequences(spark, d).select("ref_id", "name")
    rows = split.split_chunks(contigs, chunks, narrow_mismatches(spark, d).join(names, "ref_id"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "seq"))), lambda x: x["seq"]), "").alias("seq")
    return rows.groupBy("name", "piece_ord", "piece_name").agg(whole).select("name", "piece_ord", "piece_name", F.length("seq").cast("bigint").alias("length"), F.md5("seq").alias("seq_md5"))


def sam_files(spark, d):
    """Alignments as SAM lines, and back; ends of lines are trimmed of nothing else."""
    path = _folder(spark, "sam")
    rows = fx.alignments(spark, d).withColumn("read_name", right_trim(F.concat("read_name", F.lit(" \t"))))
    refs = fx.references(spark, d).select(F.concat(F.lit("@SQ\tSN:"), "ref_name", F.lit("\tLN:"), F.col("ref_length").cast("string")).alias("value"), F.col("ref_id").cast("bigint").alias("ord"))
    name = lambda c: F.when(F.col(c) < 0, "*").otherwise(F.concat(F.lit("doc"), F.col(c).cast("string")))
    fields = [F.col("read_name"), F.col("flag").cast("string"), name("ref_id"), (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"), F.lit("*"), F.when(F.col("next_ref_id") == F.col("ref_id"), "=").otherwise(name("next_ref_id")), (F.col("next_pos") + 1).cast("string"), F.lit("0"), F.lit("*"), F.lit("*")]
    body = rows.select(F.concat_ws("\t", *fields).alias("value"))
    # partitions of a union follow each other, so the header is in the first files and no line is moved
    refs.orderBy("ord").select("value").union(body).write.text(path)
    return readers.read_sam(spark, path)[1].select("read_name", "flag", "ref_id", "pos", "mapq", "next_ref_id", "next_pos")


def _bam(spark, d, by_place):
    path = _folder(spark, "bam")
    bam.write_bam(fx.alignments(spark, d), fx.references(spark, d), path, by_place)
    return path


def bam_files(spark, d):
    """Alignments as BAM files, and back, decoding the columns that the filter needs."""
    return bam.read_bam(spark, _bam(spark, d, False), ("read_name", "flag", "ref_id", "pos", "mapq", "next_ref_id", "next_pos"))[1]


def bam_region(spark, d):
    """Good alignments in one region of a sorted BAM: stretches of other places are not read."""
    columns = ("read_name", "flag", "pos", "next_ref_id", "next_pos")
    return bam.read_bam(spark, _bam(spark, d, True), columns, {"ref_id": (7, 7), "pos": (500, 1499), "mapq": (40, None)})[1]


def edge_files(spark, d):
    path = _folder(spark, "edges")
    edges.write_edges(edge_counts(spark, d), path)
    return edges.read_edges(spark, path)


def node_files(spark, d):
    path = _folder(spark, "nodes")
    sinks.write_nodes(_nodes(spark, d), path)
    return readers.read_nodes(spark, path)


def coordinate_files(spark, d):
    path = _folder(spark, "coords")
    fx.coordinates(spark, d).select((F.col("node_id") + 1).alias("id"), "x", "y").write.csv(path, sep="\t", header=True)
    return readers.read_coords(spark, path)


def group_files(spark, d):
    path = _folder(spark, "groups")
    sinks.write_groups(group_contents(spark, d), path)
    return spark.read.csv(path, sep="\t", header=True, schema="`#Contig` string, RECounts bigint, Length bigint, group_label string").select("group_label", F.col("#Contig").alias("contig"), F.col("RECounts").alias("re_counts"), F.col("Length").alias("length"))


def reduced_files(spark, d):
    """The kept alignments as an ordered table: each file's rows follow those of the one before."""
    path = _folder(spark, "reduced")
    sinks.write_table(reduced_alignments(spark, d), path, order_by=["aln_id"])
    rows = spark.read.parquet(path).select("aln_id", "read_name", F.col("_metadata.file_name").alias("file"))
    ranges = rows.groupBy("file").agg(F.min("aln_id").alias("least"), F.max("aln_id").alias("most"))
    # the names of part files are in the order of their partitions, one row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    overlaps = ranges.withColumn("upto", F.max("most").over(before)).agg(F.count_if(F.col("upto") >= F.col("least")).alias("n_overlaps"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("aln_id").alias("sum_ids"), F.min("aln_id").alias("first_id"), F.max("aln_id").alias("last_id")).join(F.broadcast(overlaps))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            find_sites, site_counts, site_windows, drop_secondary, filter_mapq, coordinate_sort, map_refs_to_nodes, filter_known_refs,
            near_site_alignments, mate_pairs, edge_counts, reduced_alignments, filter_summary,
            intra_contacts, contact_map, contact_map_narrow, saturation_level, depletion_score, score_track, score_track_narrow,
            wide_mismatches, narrow_mismatches, corrected_pieces,
            weighted_edges, assign_nearest, group_contents, group_sizes, pajek_lines, kmeans_groups, layout_cells, force_layout,
            enzyme_sites, fasta_files, chunk_sites, chunk_pieces, sam_files, bam_files, bam_region, edge_files, node_files, coordinate_files, group_files, reduced_files,
        )
    }


# ------------------------------------------------------------------------ SQL
_FILTER = f"""
contigs as ({fx.CONTIGS}),
parts as (select contig_ord, name, length, unnest(list_transform(string_split(seq, '{MOTIF}'), lambda x: length(x))) as piece, unnest(range(len(string_split(seq, '{MOTIF}')))) as ord,
          len(string_split(seq, '{MOTIF}')) as n from contigs),
sites0 as (select contig_ord, name, length, ord as site_ord, cast(sum(piece) over (partition by contig_ord order by ord) + ord * {len(MOTIF)} as bigint) as pos, n from parts),
sites as (select contig_ord, name, length, site_ord, pos from sites0 where site_ord < n - 1),
nodes as materialized (select row_number() over (order by contig_ord) - 1 as node_id, contig_ord, name, count(*) as site_count, length from sites group by contig_ord, name, length),
windows as materialized (select node_id, s.name, site_ord,
  case when s.length < 1000 then 0 when pos < 500 then 0 when pos + {len(MOTIF)} > s.length - 500 then pos - 500 else pos - 500 end as win_start,
  case when s.length < 1000 then s.length when pos < 500 then pos + {len(MOTIF)} + 500 when pos + {len(MOTIF)} > s.length - 500 then s.length else pos + 500 end as win_end
  from sites s join nodes using (contig_ord)),
raw as ({fx.ALIGNMENTS}),
aln as materialized (select row_number() over (order by case when ref_id < 0 then 1 else 0 end, ref_id, pos, flag & 16, read_name, flag, next_ref_id, next_pos, mapq) - 1 as aln_id, * from raw where flag & 256 = 0),
refs as (select cast(contig_ord as int) as ref_id, c.name as ref_name, (select min(node_id) from nodes n where n.name = c.name) as node_id from contigs c),
known as materialized (select a.*, o.node_id, m.node_id as next_node_id from aln a join refs o on a.ref_id = o.ref_id join refs m on a.next_ref_id = m.ref_id
          where mapq >= 40 and o.node_id is not null and m.node_id is not null),
covered as materialized (select distinct node_id, unnest(range(win_start, win_end + 1)) as pos from windows where node_id in (select node_id from known)),
near as materialized (select * from known semi join covered using (node_id, pos)),
firsts as (select *, first_value(aln_id) over w as fa, first_value(ref_id) over w as fr, first_value(pos) over w as fp, first_value(next_ref_id) over w as fnr, first_value(next_pos) over w as fnp, first_value(node_id) over w as fn
           from near window w as (partition by read_name order by aln_id)),
pairs as materialized (select read_name, fa as aln_id_a, min(aln_id) as aln_id_b, fn as node_a, arg_min(node_id, aln_id) as node_b from firsts
          where aln_id > fa and fr = next_ref_id and fnr = ref_id and fp = next_pos and fnp = pos group by read_name, fa, fn),
edges as (select least(node_a, node_b) as src, greatest(node_a, node_b) as dst, count(*) as contacts from pairs group by all),
paired as materialized (select unnest([aln_id_a, aln_id_b]) as aln_id from pairs),
reduced as materialized (select aln.* from aln join paired using (aln_id)),
weighted as (select src, dst, contacts / ((a.site_count + b.site_count) / 2.0) as weight from edges join nodes a on a.node_id = src join nodes b on b.node_id = dst)
"""


def _track(name: str, size: int, depletion: int) -> str:
    """Saturation by ranked cells, scores by a join with a number list."""
    return f"""
map_{name} as (select ref_id, (pos // {size}) * {size} as bin_s, (next_pos // {size}) * {size} as bin_e, count(*) as cnt from contacts group by all),
cells_{name} as (select ref_id, cnt, row_number() over (partition by ref_id order by cnt) as rk, count(*) over (partition by ref_id) as n from map_{name} where bin_s <> bin_e),
quant_{name} as (select distinct ref_id, n, cast(cast(0.95 as float) as double) * (n + 1.0) as q from cells_{name}),
sat_{name} as (select ref_id, cast(trunc((case when n = 1 or q < 1 then (select cast(min(cnt) as double) from cells_{name} c where c.ref_id = k.ref_id)
    when q >= n then (select cast(max(cnt) as double) from cells_{name} c where c.ref_id = k.ref_id)
    else (select cnt from cells_{name} c where c.ref_id = k.ref_id and rk = floor(q)) + (q - floor(q)) * ((select cnt from cells_{name} c where c.ref_id = k.ref_id and rk = floor(q) + 1) - (select cnt from cells_{name} c where c.ref_id = k.ref_id and rk = floor(q))) end) * 100000.0) as bigint) as sat_e5
    from quant_{name} k),
steps_{name} as (select unnest(range(1, {depletion // size})) * {size} as step),
score_{name} as (select ref_id, bin_s + step as pos, cast(sum(least(cnt * 100000, sat_e5)) as bigint) as score_e5 from map_{name} join sat_{name} using (ref_id) join steps_{name} on bin_s + step < bin_e
    where bin_e - bin_s <= {depletion} group by all),
ends_{name} as (select ref_id, min(pos) + {depletion} - 2 * {size} as lo, max(pos) - {depletion} + 3 * {size} as hi from score_{name} group by ref_id),
grid_{name} as (select ref_id, unnest(range(lo, hi, {size})) as pos from ends_{name} where lo < hi),
track_{name} as (select ref_id, pos, coalesce(score_e5, 0) as score_e5 from grid_{name} left join score_{name} using (ref_id, pos))"""


_CORRECT = f"""
mates as ({fx.MATES}),
contacts as (select ref_id, pos, next_pos from mates where ref_id <> -1 and ref_id = next_ref_id and pos <> -1 and next_pos <> -1 and mapq >= 1),
{_track("wide", WIDE, DEPLETION)},
{_track("narrow", NARROW, WIDE)},
low as (select ref_id, pos from track_wide join sat_wide using (ref_id) where score_e5 < 0.5 * sat_e5 * 0.5 * {DEPLETION / WIDE} * {DEPLETION / WIDE - 1}),
marked as (select ref_id, pos, case when lag(pos) over (partition by ref_id order by pos) = pos - {WIDE} then 0 else 1 end as new from low),
runs as (select ref_id, pos, sum(new) over (partition by ref_id order by pos) as run from marked),
wide as (select ref_id, min(pos) as start, max(pos) + {WIDE} as "end" from runs group by ref_id, run),
points as (select ref_id, pos, score_e5, row_number() over (partition by ref_id order by pos) - 1 as j, count(*) over (partition by ref_id) as g from track_narrow),
isle as (select ref_id, start, "end", row_number() over (partition by ref_id order by start) - 1 as k, (select any_value(g) from points p where p.ref_id = w.ref_id) as g,
         coalesce((select min(j) from points p where p.ref_id = w.ref_id and p.pos >= w."end"), (select any_value(g) from points p where p.ref_id = w.ref_id)) as f from wide w),
closed as (select *, k + max(f - k) over (partition by ref_id order by k) as c from isle where g is not null),
opened as (select *, coalesce(lag(c) over (partition by ref_id order by k) + 1, 0) as first from closed),
placed as (select *, (select max(j) from points p where p.ref_id = o.ref_id and p.j >= o.first and p.pos <= o.start) as r from opened o where first <= g),
goal as (select *, case when r is null then 0 else (select min(score_e5) from points p where p.ref_id = q.ref_id and p.j between q.r and q.c) end as least from placed q),
picks as (select distinct p.ref_id, p.pos from goal q join points p on p.ref_id = q.ref_id and p.pos >= q.start and p.pos < q."end" and (p.pos - q.start) % {NARROW} = 0 and p.score_e5 = q.least),
pick_runs as (select ref_id, pos, sum(new) over (partition by ref_id order by pos) as run from
    (select ref_id, pos, case when lag(pos) over (partition by ref_id order by pos) = pos - {NARROW} then 0 else 1 end as new from picks) t),
fine as (select ref_id, min(pos) as start, max(pos) + {NARROW} as "end" from pick_runs group by ref_id, run),
final as (select * from fine union all select ref_id, start, "end" from wide where ref_id not in (select ref_id from fine)),
seqs as ({fx.SEQUENCES}),
cuts as (select name, seq, length(seq) as len, start, greatest(start - 1, 0) as s, "end" - 1 as e, lag("end" - 1, 1, 0) over (partition by name order by start) as base,
         row_number() over (partition by name order by start) - 1 as k from final join seqs using (ref_id)),
pieces as (
  select name, 2 * k as piece_ord, name || '_' || (base + 1) || '_' || s as piece_name, substr(seq, base + 1, greatest(s - base, 0)) as seq from cuts
  union all select name, 2 * k + 1, name || '_' || (s + 1) || '_' || e, substr(seq, s + 1, greatest(e - s, 0)) from cuts
  union all select name, 2 * max(k) + 2, name || '_' || max(e) || '_' || any_value(len), substr(any_value(seq), max(e) + 1) from cuts group by name having max(e) < any_value(len)
  union all select name, 0, name, seq from seqs where name not in (select name from cuts))
"""

_GROUPS = """
coords as (select vec_id as node_id, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y from embeddings),
centers as (select cast(node_id % 10 as int) as group_id, cast(sum(cast(trunc(x * 1000000) as bigint)) as double) / count(*) / 1000000.0 as x, cast(sum(cast(trunc(y * 1000000) as bigint)) as double) / count(*) / 1000000.0 as y from coords group by 1),
dist as (select node_id, group_id, (a.x - c.x) * (a.x - c.x) + (a.y - c.y) * (a.y - c.y) as d2 from coords a, centers c),
members as (select group_id, node_id from dist qualify row_number() over (partition by node_id order by d2, group_id) = 1)
"""


def _kmeans(k: int = 10, seed: int = 806) -> str:
    """First centres and rounds of k-means as steps over lists of centres."""
    return f"""
points as (select vec_id as node_id, cast(floor(cast(embedding[1] as double) * {graph.UNITS}) as bigint) as x, cast(floor(cast(embedding[2] as double) * {graph.UNITS}) as bigint) as y from embeddings),
drawn as (select *, md5('{seed}:' || node_id) as h from points order by h, node_id limit {graph.CANDIDATES * k}),
candidates as (select list({{'id': node_id, 'x': x, 'y': y}} order by h, node_id) as s from drawn),
firsts as (select list_reduce(list_prepend(s[1:1], list_transform(range(1, {k}), lambda i: s[1:0])), lambda c, z: list_concat(c, list_transform(
    list_sort(list_transform(s, lambda p: {{'far': -list_min(list_transform(c, lambda q: (p.x - q.x)::double * (p.x - q.x)::double + (p.y - q.y)::double * (p.y - q.y)::double)), 'p': p}}))[1:1], lambda b: b.p))) as c from candidates),
rounds as (select 0 as i, list_transform(c, lambda q: {{'x': q.x, 'y': q.y}}) as c, false as still from firsts
  union all
  select i + 1, list_transform(range(len(c)), lambda g: coalesce(list_filter(m, lambda e: e.g = g)[1].c, c[g + 1])), list_transform(range(len(c)), lambda g: coalesce(list_filter(m, lambda e: e.g = g)[1].c, c[g + 1])) = c from (
    select i, c, list({{'g': g, 'c': {{'x': cx, 'y': cy}}}}) as m from (
      select i, c, g, ((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*))::bigint as cx, ((sum(y) - (sum(y) % count(*) + count(*)) % count(*)) // count(*))::bigint as cy from (
        select i, c, x, y, list_sort(list_transform(range(len(c)), lambda g: {{'d2': (x - c[g + 1].x)::double * (x - c[g + 1].x)::double + (y - c[g + 1].y)::double * (y - c[g + 1].y)::double, 'g': g}}))[1].g as g
        from rounds, points where not still and i < 100) near group by i, c, g) sums group by i, c) maps),
last as (select c from rounds order by i desc limit 1)
select cast(list_sort(list_transform(range(len(c)), lambda g: {{'d2': (x - c[g + 1].x)::double * (x - c[g + 1].x)::double + (y - c[g + 1].y)::double * (y - c[g + 1].y)::double, 'g': g}}))[1].g as int) as group_id, node_id from points, last"""


def oracle_sql() -> dict[str, str]:
    def of(ctes: str, select: str) -> str:
        return f"with {ctes.strip()}\n{select}"

    raw = of(_FILTER, "select * from raw where {}")
    first = {
        "find_sites": "select name, site_ord, pos from sites",
        "site_counts": "select node_id, name, site_count, length from nodes",
        "site_windows": "select * from windows",
        "coordinate_sort": "select * from aln",
        "map_refs_to_nodes": "select ref_id, ref_name, coalesce(node_id, -1) as node_id from refs",
        "filter_known_refs": "select * from known",
        "near_site_alignments": "select * from near",
        "mate_pairs": "select * from pairs",
        "edge_counts": "select * from edges",
        "reduced_alignments": "select * from reduced",
        "edge_files": "select * from edges",
        "node_files": "select node_id, name, site_count, length from nodes",
        "reduced_files": "select count(*) as n_rows, cast(sum(aln_id) as bigint) as sum_ids, min(aln_id) as first_id, max(aln_id) as last_id, cast(0 as bigint) as n_overlaps from reduced",
        "filter_summary": "select (select count(*) from aln) as total_rows, (select count(*) from reduced) as kept_rows, (select count(*) from nodes) as n_nodes",
        "weighted_edges": "select * from weighted",
        "pajek_lines": """
select 0 as section, cast(0 as bigint) as ord, '*Vertices ' || count(*) as value from nodes
union all select 1, node_id, (node_id + 1) || ' "' || name || '"' from nodes
union all select 2, 0, '*arcs'
union all select 3, row_number() over (order by src, dst) - 1, (dst + 1) || ' ' || (src + 1) || ' ' || printf('%.15f', weight) from weighted""",
    }
    second = {
        "intra_contacts": "select * from contacts",
        "contact_map": "select * from map_wide",
        "contact_map_narrow": "select * from map_narrow",
        "saturation_level": "select * from sat_wide",
        "depletion_score": "select * from score_wide",
        "score_track": "select * from track_wide",
        "score_track_narrow": "select * from track_narrow",
        "wide_mismatches": 'select * from wide',
        "narrow_mismatches": "select * from final",
        "chunk_pieces": "select name, piece_ord, piece_name, length(seq) as length, md5(replace(seq, 'C', 'A')) as seq_md5 from pieces",
        "corrected_pieces": "select name, piece_ord, piece_name, length(seq) as length, md5(seq) as seq_md5 from pieces",
    }
    return (
        {k: of(_FILTER, v) for k, v in first.items()}
        | {"drop_secondary": raw.format("flag & 256 = 0"), "filter_mapq": raw.format("mapq >= 40")}
        | {k: of(_CORRECT, v) for k, v in second.items()}
        | {
            "kmeans_groups": "with recursive" + _kmeans(),
            "layout_cells": of(_GROUPS, f"""
, box as (select min(x) as x0, min(y) as y0, greatest(max(x) - min(x), max(y) - min(y), 1e-6::double) as side from coords),
placed as (select least(floor((x - x0) / side * {1 << quadtree.DEPTH}::double)::bigint, {(1 << quadtree.DEPTH) - 1}) as px, least(floor((y - y0) / side * {1 << quadtree.DEPTH}::double)::bigint, {(1 << quadtree.DEPTH) - 1}) as py from coords, box),
cells as (select l::int as level, px // (1 << ({quadtree.DEPTH} - l))::bigint as cx, py // (1 << ({quadtree.DEPTH} - l))::bigint as cy, count(*) as n from placed, range({quadtree.DEPTH + 1}) t(l) group by all)
select * from cells c where level = 0 or exists (select 1 from cells a where a.level = c.level - 1 and a.cx = c.cx // 2 and a.cy = c.cy // 2 and a.n > {quadtree.LEAF})""".strip()),
            "assign_nearest": of(_GROUPS, "select * from members"),
            "group_sizes": of(_GROUPS, "select group_id, count(*) as n_contigs from members group by group_id"),
            "sam_files": raw.format("true"),
            "bam_files": f"select read_name, flag, ref_id, pos, mapq, next_ref_id, next_pos from ({fx.ALIGNMENTS}) a",
            "bam_region": f"select read_name, flag, pos, next_ref_id, next_pos from ({fx.ALIGNMENTS}) a where ref_id = 7 and pos between 500 and 1499 and mapq >= 40",
            "fasta_files": f"select row_number() over (order by name) - 1 as contig_ord, name, length(seq) as length, md5(seq) as seq_md5 from ({fx.SEQUENCES}) s",
            "coordinate_files": of(_GROUPS, "select * from coords"),
            "enzyme_sites": f"""
with parts as (select name, length(unnest(string_split(seq, 'GATC'))) as piece, unnest(range(len(string_split(seq, 'GATC')))) as ord, len(string_split(seq, 'GATC')) as n from ({fx.SEQUENCES}) s),
places as (select name, sum(piece) over (partition by name order by ord) + 4 * ord as pos, ord, n from parts)
select name, count(*) as n_sites, cast(min(pos) as bigint) as first_pos, cast(max(pos) as bigint) as last_pos, cast(sum(pos) as bigint) as sum_pos from places where ord < n - 1 group by name""",
            "chunk_sites": f"""
with seqs as (select name, replace(seq, 'C', 'A') as seq from ({fx.SEQUENCES}) s),
parts as (select name, length(unnest(string_split(seq, '{DOUBLE}'))) as piece, unnest(range(len(string_split(seq, '{DOUBLE}')))) as ord, len(string_split(seq, '{DOUBLE}')) as n from seqs),
places as (select name, sum(piece) over (partition by name order by ord) + 2 * ord as pos, ord, n from parts)
select name, count(*) as n_sites, max(ord) as last_ord, cast(min(pos) as bigint) as first_pos, cast(max(pos) as bigint) as last_pos, cast(sum(pos) as bigint) as sum_pos, cast(sum(pos * ord) as bigint) as sum_product from places where ord < n - 1 group by name""",
            "group_files": of(_GROUPS + "," + _FILTER, "select (select count(distinct group_id) from members) || 'g' || (group_id + 1) as group_label, name as contig, site_count as re_counts, length from members join nodes using (node_id)"),
            "group_contents": of(_GROUPS + "," + _FILTER, "select group_id, node_id, name, site_count, length from members join nodes using (node_id)"),
        }
    )
