"""Independent SQL for every registered query (DuckDB dialect).

These statements recompute each result from the raw tables with plain SQL — the
rank iteration as a recursive CTE — so the Spark jobs can be checked against a
second engine. Ranks are compared as ``rank * N``, rounded to 7 decimals on both sides,
and top-k ties are broken on the rounded value, then the id.
"""

from __future__ import annotations

# Fixed values shared with the Spark side of every query.
DAMPING = 0.85
EPSILON = 1e-6
MAX_ITER = 100
RANK_DIGITS = 7
SMALL_DIGITS = 12
WEIGHT_DIGITS = 15
LOG_DIGITS = 10
SEED = 42


def _hash(expr: str) -> str:
    """The generator's hash key: first 15 hex digits of md5(text) as BIGINT."""
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


def _lines(keys: str = "") -> str:
    inward = "(l_partkey % 3 = 0 or l_linenumber % 2 = 0)"
    return f"""
  select {keys}case when {inward} then l_suppkey else l_partkey end as src,
         case when {inward} then l_partkey else l_suppkey end as dst
  from lineitem where l_partkey is not null and l_suppkey is not null"""


def _ends(edges: str) -> str:
    return f"""
  select distinct graph_id, id from (
    select graph_id, src as id from ({edges}) a
    union all select graph_id, dst from ({edges}) b) u"""


PARTS_EDGES = _lines()
PARTS_NODES = "select p_partkey as id from part"
PARTS_SEEDS = "select p_partkey as id from part where p_partkey < 5"

BATCH_EDGES = _lines("l_returnflag as graph_id, ")
BATCH_NODES = _ends(BATCH_EDGES)
MANY_EDGES = _lines("l_returnflag || '-' || (l_orderkey % 50)::VARCHAR as graph_id, ")
MANY_NODES = _ends(MANY_EDGES)
BATCH_SEEDS = f"""
  select graph_id, id from ({BATCH_NODES}) n
  qualify row_number() over (partition by graph_id
                             order by {_hash("id::VARCHAR || ':" + str(SEED) + "'")}, id) <= 5"""

BIPARTITE_EDGES = """
  select distinct o_custkey * 2 as src, l_suppkey * 2 + 1 as dst
  from lineitem join orders on l_orderkey = o_orderkey
  where o_custkey is not null and l_suppkey is not null"""
BIPARTITE_NODES = f"""
  select src as id from ({BIPARTITE_EDGES}) a union select dst from ({BIPARTITE_EDGES}) b"""
FLAG_EDGES = """
  select -ascii(l_returnflag)::BIGINT as src, l_partkey as dst from lineitem
  where l_partkey is not null and l_returnflag is not null
  union all select l_partkey, -ascii(l_returnflag)::BIGINT from lineitem
  where l_partkey is not null and l_returnflag is not null"""
FLAG_NODES = f"""
  select src as id from ({FLAG_EDGES}) a union select dst from ({FLAG_EDGES}) b"""


def rank_cte(
    nodes: str,
    edges: str,
    seeds: str | None = None,
    keys: tuple[str, ...] = (),
    damping: float = DAMPING,
    epsilon: float = EPSILON,
    max_iter: int = MAX_ITER,
) -> str:
    """``WITH RECURSIVE`` prefix defining ``g_nodes, g_edges, deg, tele, pr``.

    ``pr(keys..., g, iter, id, rank, diff)`` holds every iteration of every run;
    a run keeps iterating while its last L1 change is ``>= epsilon``. Without keys
    a constant run key ``g = 0`` is used.
    """
    ks = list(keys) or ["g"]
    kcols = ", ".join(ks)
    sel = (lambda a: ", ".join(f"{a}.{k}" for k in ks))
    on = (lambda a, b: " and ".join(f"{a}.{k} = {b}.{k}" for k in ks))
    n_src = f"select {'0 as g, ' if not keys else ''}* from ({nodes}) n0"
    e_src = f"select {'0 as g, ' if not keys else ''}* from ({edges}) e0"
    d = f"{float(damping)!r}::double"
    if seeds is not None:
        s_src = f"select distinct {'0 as g, ' if not keys else ''}* from ({seeds}) s0"
        seed_part = f""",
g_seeds as (select s.* from ({s_src}) s join g_nodes n on {on('s', 'n')} and s.id = n.id),
sc as (select {kcols}, count(*)::double as s from g_seeds group by {kcols})"""
        teleport = f"""case when sc.s is null then 1.0::double / c.n
                 when sd.id is not null then 1.0::double / sc.s else 0.0::double end"""
        seed_join = f"""
    left join sc on {on('sc', 'dg')}
    left join g_seeds sd on {on('sd', 'dg')} and sd.id = dg.id"""
    else:
        seed_part, teleport, seed_join = "", "1.0::double / c.n", ""
    return f"""with recursive
g_nodes as ({n_src}),
g_edges as ({e_src}){seed_part},
deg as (select {sel('n')}, n.id, count(e.dst) as outdeg
        from g_nodes n left join g_edges e on {on('e', 'n')} and e.src = n.id
        group by {sel('n')}, n.id),
cnt as (select {kcols}, count(*)::double as n from g_nodes group by {kcols}),
tele as (select {sel('dg')}, dg.id, dg.outdeg, c.n, {teleport} as t
         from deg dg join cnt c on {on('c', 'dg')}{seed_join}),
wts as (select {sel('e')}, e.src, e.dst, 1.0::double / dg.outdeg as w
        from g_edges e join deg dg on {on('dg', 'e')} and dg.id = e.src),
pr({kcols}, iter, id, rank, diff) as (
  select {kcols}, 0, id, 1.0::double / n, 1e300::double from tele
  union all
  select {kcols}, iter, id, new_rank,
         sum(abs(new_rank - old_rank)) over (partition by {kcols}) from (
    select {sel('p')}, p.iter + 1 as iter, p.id, p.rank as old_rank,
           t.t * ((1 - {d}) + {d} * dm.dm) + {d} * coalesce(s.inc, 0) as new_rank
    from pr p
    join tele t on {on('t', 'p')} and t.id = p.id
    left join (select {sel('w')}, w.dst, sum(p2.rank * w.w) as inc
               from pr p2 join wts w on {on('w', 'p2')} and w.src = p2.id
               group by {sel('w')}, w.dst) s on {on('s', 'p')} and s.dst = p.id
    join (select {sel('p3')}, coalesce(sum(case when t3.outdeg = 0 then p3.rank end), 0) as dm
          from pr p3 join tele t3 on {on('t3', 'p3')} and t3.id = p3.id
          group by {sel('p3')}) dm on {on('dm', 'p')}
    where p.iter < {int(max_iter)} and p.diff >= {float(epsilon)!r}) x),
last as (select {kcols}, iter, id, rank, diff from pr
         qualify iter = max(iter) over (partition by {kcols})),
final as (select {sel('l')}, l.iter, l.id, l.rank, l.diff, l.rank * c.n as scaled
          from last l join cnt c on {on('c', 'l')})
"""


def _round(col: str, digits: int = RANK_DIGITS) -> str:
    """Half-up rounding in binary arithmetic, the same computation as the Spark side."""
    return f"(floor(({col}) * 1e{digits} + 0.5) / 1e{digits})"


def _ranks(cte: str, keys: tuple[str, ...] = ()) -> str:
    cols = ", ".join(keys) + ", " if keys else ""
    return f"{cte}select {cols}id, {_round('scaled')} as rank from final"


def _top(cte: str, k: int, keys: tuple[str, ...] = (), with_position: bool = True) -> str:
    cols = ", ".join(keys) + ", " if keys else ""
    part = f"partition by {', '.join(keys)} " if keys else ""
    pos = "position, " if with_position else ""
    return f"""{cte}select {cols}{pos}id, rank from (
  select {cols}id, {_round('scaled')} as rank,
         row_number() over ({part}order by {_round('scaled')} desc, id) as position
  from final) t where position <= {k}"""


def _parts(seeds: bool = False, **kw) -> str:
    return rank_cte(PARTS_NODES, PARTS_EDGES, PARTS_SEEDS if seeds else None, **kw)


def _modes(sql: str) -> str:
    return f"""select 'standard' as mode, * from ({sql}) m1
  union all select 'personalized' as mode, * from ({sql}) m2"""


def _compare_cte(nodes: str, edges: str, seeds: str, keys: tuple[str, ...]) -> str:
    run_keys = (*keys, "mode")
    return rank_cte(
        _modes(nodes),
        _modes(edges),
        f"select 'personalized' as mode, * from ({seeds}) sm",
        keys=run_keys,
    )


def _single_compare() -> str:
    return rank_cte(
        _modes(PARTS_NODES),
        _modes(PARTS_EDGES),
        f"select 'personalized' as mode, * from ({PARTS_SEEDS}) sm",
        keys=("mode",),
    )


def _batch_compare() -> str:
    return _compare_cte(BATCH_NODES, BATCH_EDGES, BATCH_SEEDS, ("graph_id",))


def _pair_top(cte: str, keys: tuple[str, ...]) -> str:
    """CTE text adding ``top10(keys..., mode, position, id, rank)``."""
    run = (*keys, "mode")
    cols = ", ".join(run)
    return f"""{cte}, top10 as (
  select {cols}, id, {_round('scaled')} as rank,
         row_number() over (partition by {cols} order by {_round('scaled')} desc, id) as position
  from final qualify position <= 10)
"""


def _jaccard(keys: tuple[str, ...]) -> str:
    if keys:
        kc = ", ".join(keys)
        return f"""select {kc}, case when count(*) = 0 then 0.0 else
         count(*) filter (where a.id is not null and b.id is not null)::double / count(*) end as overlap
  from (select {kc}, id from top10 where mode = 'standard') a
  full join (select {kc}, id from top10 where mode = 'personalized') b using ({kc}, id)
  group by {kc}"""
    return """select case when count(*) = 0 then 0.0 else
         count(*) filter (where a.id is not null and b.id is not null)::double / count(*) end as overlap
  from (select id from top10 where mode = 'standard') a
  full join (select id from top10 where mode = 'personalized') b using (id)"""


def statements() -> dict[str, str]:
    r_e, r_n = PARTS_EDGES, PARTS_NODES
    deg = f"select src, count(*) as c from ({r_e}) e group by src"
    one_step = f"""{_parts()}, one as (
  select p.id, p.rank as old_rank, t.outdeg, t.n,
         t.t * ((1 - 0.85::double) + 0.85::double * dm.dm) + 0.85::double * coalesce(s.inc, 0) as rank
  from pr p join tele t on t.g = p.g and t.id = p.id
  left join (select w.dst, sum(p2.rank * w.w) as inc from pr p2 join wts w on w.src = p2.id
             where p2.iter = 0 group by w.dst) s on s.dst = p.id
  join (select coalesce(sum(case when t3.outdeg = 0 then p3.rank end), 0) as dm
        from pr p3 join tele t3 on t3.id = p3.id where p3.iter = 0) dm on true
  where p.iter = 0)
"""
    q: dict[str, str] = {}
    q["node_set"] = f"select src as id from ({r_e}) a union select dst from ({r_e}) b"
    q["adjacency"] = f"""select n.id, 0 as part, coalesce(a.c, 0)::BIGINT as out_degree,
       coalesce(a.nb, '') as out_neighbors
  from ({r_n}) n left join (
    select src, count(*) as c, array_to_string(list_sort(list(dst)), ' ') as nb
    from ({r_e}) e group by src) a on a.src = n.id"""
    q["adjacency_exploded"] = f"select src, dst from ({r_e}) e"
    q["out_degree"] = f"""select n.id, coalesce(d.c, 0)::BIGINT as out_degree
  from ({r_n}) n left join ({deg}) d on d.src = n.id"""
    q["dangling_nodes"] = f"""select id from ({r_n}) n where not exists (
  select 1 from ({r_e}) e where e.src = n.id)"""
    q["graph_summary"] = f"""select count(*) as n_nodes, coalesce(sum(coalesce(d.c, 0)), 0)::BIGINT as n_edges,
       count(*) filter (where d.c is null) as n_dangling
  from ({r_n}) n left join ({deg}) d on d.src = n.id"""
    q["clean_edges"] = f"select distinct src, dst from ({r_e}) e where src <> dst"
    q["weighted_edges"] = f"""select p.src, p.dst, p.m as multiplicity, {_round('p.m::double / d.c', WEIGHT_DIGITS)} as weight
  from (select src, dst, count(*) as m from ({r_e}) e group by src, dst) p
  join ({deg}) d on d.src = p.src"""
    q["edge_sample"] = f"""with d as (select distinct src, dst from ({r_e}) e)
select src, dst from d
qualify row_number() over (order by {_hash("src::VARCHAR || ':' || dst::VARCHAR || ':" + str(SEED) + "'")}, src, dst)
        <= (select count(*) from d) // 2"""
    q["initial_rank"] = f"{_parts(max_iter=0)}select id, {_round('scaled')} as rank from final"
    q["contributions"] = f"""{_parts(max_iter=0)}select w.src, w.dst,
       {_round('sum(w.w * p.scaled)', SMALL_DIGITS)} as contribution
  from wts w join final p on p.id = w.src group by w.src, w.dst"""
    q["inflow"] = f"""{_parts(max_iter=0)}select w.dst as id, {_round('sum(w.w * p.scaled)')} as inflow
  from wts w join final p on p.id = w.src group by w.dst"""
    q["rank_step"] = f"{one_step}select id, {_round('rank * n')} as rank from one"
    q["l1_change"] = f"{one_step}select {_round('sum(abs(rank - old_rank))', SMALL_DIGITS)} as l1_diff from one"
    q["dangling_mass"] = f"""{one_step}select {_round('coalesce(sum(rank), 0)', SMALL_DIGITS)} as dangling_mass
  from one where outdeg = 0"""
    q["pagerank"] = _ranks(_parts())
    q["pagerank_fixed5"] = _ranks(_parts(max_iter=5, epsilon=0.0))
    q["pagerank_width"] = _ranks(_parts())
    q["pagerank_top10"] = _top(_parts(), 10, with_position=False)
    q["pagerank_positions"] = _top(_parts(), 10)
    q["iteration_log"] = f"""{_parts()}select i.iter as iteration, {_round('i.diff', LOG_DIGITS)} as l1_diff,
       {_round('m.dm', LOG_DIGITS)} as dangling_mass
  from (select iter, max(diff) as diff from pr where iter > 0 group by iter) i
  join (select p.iter + 1 as iter, coalesce(sum(case when t.outdeg = 0 then p.rank end), 0) as dm
        from pr p join tele t on t.id = p.id group by p.iter) m on m.iter = i.iter"""
    q["teleport"] = f"""with s as (select distinct s.id from ({PARTS_SEEDS}) s join ({r_n}) n on n.id = s.id)
select n.id, case when s.id is not null then 1.0::double / (select count(*) from s) else 0.0 end as teleport
  from ({r_n}) n left join s on s.id = n.id"""
    q["seed_check"] = f"""with nodes as (select src as id from ({r_e}) a union select dst from ({r_e}) b)
select s.id, exists (select 1 from nodes n where n.id = s.id) as known
  from (select distinct id from ({PARTS_SEEDS}) x) s"""
    q["pagerank_personalized"] = _ranks(_parts(seeds=True))
    q["side_by_side"] = f"""{_pair_top(_single_compare(), ())}select coalesce(a.position, b.position) as position,
       a.id as std_id, a.rank as std_rank, b.id as ppr_id, b.rank as ppr_rank
  from (select * from top10 where mode = 'standard') a
  full join (select * from top10 where mode = 'personalized') b on a.position = b.position"""
    q["topk_jaccard"] = f"{_pair_top(_single_compare(), ())}{_jaccard(())}"
    q["validation"] = f"""{_parts()}select count(*) as rank_count, (select count(*) from ({r_n}) n) as node_count,
       count(*) filter (where rank < 0) as negative_count,
       count(*) filter (where rank < 0) = 0 as all_non_negative,
       (floor(sum(rank) * 1e6 + 0.5) / 1e6) as sum_of_ranks,
       abs(sum(rank) - 1.0) < 1e-4 as sum_valid,
       count(*) = (select count(*) from ({r_n}) n) as count_matches,
       (select count(*) from ((select id from final except all select id from ({r_n}) n)
         union all (select id from ({r_n}) n except all select id from final)) x) = 0 as ids_match,
       count(*) filter (where rank < 0) = 0 and abs(sum(rank) - 1.0) < 1e-4
         and count(*) = (select count(*) from ({r_n}) n) as all_checks_passed
  from final"""
    q["dangling_ranks"] = f"""{_parts()}select f.id, {_round('f.scaled')} as rank
  from final f join tele t on t.id = f.id where t.outdeg = 0"""
    q["batch_ranks"] = _ranks(_batch_compare(), ("graph_id", "mode"))
    q["batch_topk"] = _top(_batch_compare(), 10, ("graph_id", "mode"))
    q["batch_seeds"] = BATCH_SEEDS
    q["batch_overlap"] = f"{_pair_top(_batch_compare(), ('graph_id',))}{_jaccard(('graph_id',))}"
    q["mean_overlap"] = f"""{_pair_top(_batch_compare(), ('graph_id',))}, ov as ({_jaccard(('graph_id',))})
select avg(overlap) as average_overlap, count(*) as num_graphs from ov"""
    q["pagerank_bipartite"] = _ranks(rank_cte(BIPARTITE_NODES, BIPARTITE_EDGES))
    q["pagerank_hub_split"] = _ranks(rank_cte(FLAG_NODES, FLAG_EDGES, max_iter=10, epsilon=0.0))
    q["batch_many"] = _ranks(rank_cte(MANY_NODES, MANY_EDGES, keys=("graph_id",)), ("graph_id",))
    q["rank_summary"] = f"""{rank_cte(BATCH_NODES, BATCH_EDGES, keys=("graph_id",))}, best as (
  select graph_id, id, row_number() over (partition by graph_id order by {_round('scaled')} desc, id) as position
  from final qualify position <= 10)
select b.graph_id, string_agg(b.id::VARCHAR, ' ' order by b.position) as top_ids, any_value(e.iter) as iterations,
       any_value(e.diff) < {EPSILON!r} as converged
  from best b join (select graph_id, max(iter) as iter, max(diff) as diff from final group by graph_id) e
  on e.graph_id = b.graph_id group by b.graph_id"""
    ids = "string_agg(id::VARCHAR, ' ' order by position)"
    q["experiment_details"] = f"""{_pair_top(_batch_compare(), ('graph_id',))}, ov as ({_jaccard(('graph_id',))})
select graph_id, a.ids as std_top_k, b.ids as ppr_top_k, ov.overlap as overlap_score from ov
  join (select graph_id, {ids} as ids from top10 where mode = 'standard' group by graph_id) a using (graph_id)
  join (select graph_id, {ids} as ids from top10 where mode = 'personalized' group by graph_id) b using (graph_id)"""
    q["adjacency_split"] = f"""select n.id, greatest(1, ceil(coalesce(a.c, 0) / 16.0))::BIGINT as n_parts,
       greatest(1, ceil(coalesce(a.c, 0) / 16.0))::BIGINT - 1 as last_part, least(16, coalesce(a.c, 0))::BIGINT as longest,
       coalesce(a.nb, '') as out_neighbors
  from ({r_n}) n left join (
    select src, count(*) as c, array_to_string(list_sort(list(dst)), ' ') as nb
    from ({r_e}) e group by src) a on a.src = n.id"""
    q["edge_list_parse"] = """select l_orderkey as src,
       case when l_linenumber = 4 then -l_suppkey else l_partkey end as dst
  from lineitem where l_linenumber in (1, 2, 4)"""
    q["edge_list_rejects"] = """select case l_linenumber
         when 5 then l_orderkey::VARCHAR || ' ' || l_partkey::VARCHAR || ' ' || l_suppkey::VARCHAR
         when 6 then l_orderkey::VARCHAR || ',' || l_partkey::VARCHAR
         else 'x' || l_orderkey::VARCHAR || ' ' || l_partkey::VARCHAR end as line,
       case when l_linenumber = 7 then 'fields must be integers' else 'expected two fields' end as reason
  from lineitem where l_linenumber in (5, 6, 7)"""
    q["graph_json_parse"] = """select l_orderkey as src, l_partkey as dst from lineitem where l_linenumber in (1, 2, 7)
  union all select l_orderkey, l_suppkey from lineitem where l_linenumber in (2, 7)"""
    q["graph_json_nodes"] = """select l_orderkey as id from lineitem where l_linenumber in (1, 2, 7)
  union select l_partkey from lineitem where l_linenumber = 1"""
    q["graph_json_rejects"] = """select case l_linenumber when 3 then format('{{"foo": {}}}', l_orderkey)
         when 4 then format('{{"id": {}, "outNeighbors": [{}', l_orderkey, l_partkey)
         when 5 then format('{{"id": "x{}", "outNeighbors": []}}', l_orderkey)
         else format('{{"id": {}, "outNeighbors": [{}, null]}}', l_orderkey, l_partkey) end as line,
       case l_linenumber when 3 then 'neither ''id'' nor ''nodes''' when 6 then 'NULL node id or neighbor'
         else 'not graph JSON' end as reason
  from lineitem where l_linenumber in (3, 4, 5, 6)"""
    q["seed_parse"] = """select distinct id from (
  select l_partkey as id from lineitem union all select l_suppkey from lineitem
  union all select l_linenumber from lineitem where l_linenumber not in (5, 6)
  union all select l_orderkey from lineitem where l_linenumber not in (2, 7)) s"""
    q["seed_rejects"] = """select '+-' || l_partkey::VARCHAR as entry, 'not an integer' as reason
  from lineitem where l_linenumber = 5
  union all select l_partkey::VARCHAR || '99999999999999999999', 'out of range' from lineitem where l_linenumber = 6
  union all select l_orderkey::VARCHAR || ' 1', 'not an integer' from lineitem where l_linenumber = 7"""
    q["graph_json_rows"] = f"""select n.id, 0::BIGINT as part, '{{"id":' || n.id::VARCHAR || ',"outNeighbors":[' ||
       coalesce(a.nb, '') || ']}}' as json
  from ({r_n}) n left join (
    select src, array_to_string(list_sort(list(dst)), ',') as nb from ({r_e}) e group by src) a
  on a.src = n.id"""
    q["graph_document"] = f"""select src, dst, count(*) as multiplicity from ({r_e}) e group by src, dst
union all select id as src, null as dst, 0::BIGINT as multiplicity from ({r_n}) n
  where id not in (select src from ({r_e}) e)"""
    q["adjacency_runs"] = f"""select p.src as id, p.dst, d.c as out_degree, p.m as multiplicity, true as bounded
  from (select src, dst, count(*) as m from ({r_e}) e group by src, dst) p join ({deg}) d on d.src = p.src"""
    return q
