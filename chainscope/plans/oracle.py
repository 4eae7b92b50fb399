"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Column names and types follow the Spark side: counts BIGINT, sums
DECIMAL(38,0), averages DOUBLE.
"""

from __future__ import annotations

from chainscope.sources import bindings as b

INT_RE = r"'^\s*[+-]?[0-9]+\s*$'"


def _with(**views: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in views.items()) + "\n"


TX = _with(tx=b.TX_ORDERS_SQL)
TXC = _with(tx=b.TX_ORDERS_SQL, contracts=b.CONTRACTS_SQL)
DAY = _with(tx=b.TRANSFERS_DAY_SQL)

CLEAN_RAW = f"""SELECT hash, from_address, to_address, CAST(trim(value) AS DECIMAL(38,0)) AS value,
  CAST(trim(block_timestamp) AS BIGINT) AS block_timestamp FROM raw
  WHERE regexp_matches(block_timestamp, {INT_RE}) AND regexp_matches(value, {INT_RE})"""

RECEIVED = """SELECT to_address AS address, CAST(sum(value) AS DECIMAL(38,0)) AS total_value FROM tx
  WHERE value IS NOT NULL AND to_address IS NOT NULL AND trim(to_address) <> '' GROUP BY to_address"""

MONTHLY_SUM = """SELECT strftime(CAST(date_trunc('month', block_timestamp) AS DATE), '%m-%Y') AS month,
  CAST(date_trunc('month', block_timestamp) AS DATE) AS month_start,
  CAST(count(*) AS BIGINT) AS n_transactions, CAST(sum(value) AS DECIMAL(38,0)) AS total_value
  FROM tx WHERE value IS NOT NULL GROUP BY 2"""

NONSELF = "SELECT * FROM tx WHERE from_address IS DISTINCT FROM to_address"
NET = f"""nonself AS ({NONSELF}),
legs AS (SELECT from_address AS address, -value AS amount FROM nonself
         UNION ALL SELECT to_address AS address, value AS amount FROM nonself),
net AS (SELECT address, CAST(sum(amount) AS DECIMAL(38,0)) AS net_value FROM legs GROUP BY address),
stats AS (SELECT CAST(count(*) AS BIGINT) AS n_transfers, CAST(sum(value) AS DECIMAL(38,0)) AS total_value,
          CAST(sum(value) AS DOUBLE) / count(*) AS avg_value FROM nonself)
"""

ORACLE: dict[str, str] = {
    "clean_transactions": _with(raw=b.TX_RAW_SQL) + CLEAN_RAW
    + " AND to_address IS NOT NULL AND trim(to_address) <> ''",
    "monthly_tx_count": TX + """SELECT strftime(CAST(date_trunc('month', block_timestamp) AS DATE), '%m-%Y') AS month,
  CAST(date_trunc('month', block_timestamp) AS DATE) AS month_start, CAST(count(*) AS BIGINT) AS n_transactions
  FROM tx GROUP BY 2 ORDER BY 2""",
    "monthly_count_sum": TX + MONTHLY_SUM,
    "monthly_avg_value": TX + f"""SELECT month, month_start, CAST(total_value AS DOUBLE) / n_transactions AS avg_value
  FROM ({MONTHLY_SUM})""",
    "monthly_raw_count_sum": _with(raw=b.TX_RAW_SQL) + f""", clean AS ({CLEAN_RAW})
SELECT strftime(date_trunc('month', make_timestamp(block_timestamp * 1000000)), '%m-%Y') AS month,
  CAST(date_trunc('month', make_timestamp(block_timestamp * 1000000)) AS DATE) AS month_start,
  CAST(count(*) AS BIGINT) AS n_transactions, CAST(sum(value) AS DECIMAL(38,0)) AS total_value
  FROM clean GROUP BY 1, 2""",
    "value_received": TX + RECEIVED,
    "contract_value_join": TXC + f"""SELECT r.address, r.total_value, c.bytecode FROM ({RECEIVED}) r
  JOIN contracts c ON r.address = c.address""",
    "top10_contracts": TXC + f"""SELECT address, total_value FROM ({RECEIVED}) r
  WHERE address IN (SELECT address FROM contracts) ORDER BY total_value DESC, address LIMIT 10""",
    "top10_contract_addresses": TXC + f"""SELECT address FROM (SELECT address, total_value FROM ({RECEIVED}) r
  WHERE address IN (SELECT address FROM contracts) ORDER BY total_value DESC, address LIMIT 10)""",
    "miner_block_size": _with(blk=b.BLOCKS_SIZE_SQL)
    + "SELECT miner, CAST(sum(size) AS BIGINT) AS total_size FROM blk WHERE size IS NOT NULL GROUP BY miner",
    "top10_miners": _with(blk=b.BLOCKS_SIZE_SQL)
    + """SELECT miner, CAST(sum(size) AS BIGINT) AS total_size FROM blk WHERE size IS NOT NULL
  GROUP BY miner ORDER BY total_size DESC, miner NULLS FIRST LIMIT 10""",
    "bottom10_miners": _with(blk=b.BLOCKS_SIZE_SQL)
    + """SELECT miner, CAST(sum(size) AS BIGINT) AS total_size FROM blk WHERE size IS NOT NULL
  GROUP BY miner ORDER BY total_size ASC, miner NULLS FIRST LIMIT 10""",
    "hex_overhead": _with(blk=b.BLOCKS_HEX_SQL) + """, n AS (SELECT CAST(coalesce(sum(
    (CASE WHEN starts_with(sha3_uncles, '0x') THEN length(sha3_uncles) - 2 ELSE 0 END)
  + (CASE WHEN starts_with(logs_bloom, '0x') THEN length(logs_bloom) - 2 ELSE 0 END)
  + (CASE WHEN starts_with(transactions_root, '0x') THEN length(transactions_root) - 2 ELSE 0 END)
  + (CASE WHEN starts_with(state_root, '0x') THEN length(state_root) - 2 ELSE 0 END)
  + (CASE WHEN starts_with(receipts_root, '0x') THEN length(receipts_root) - 2 ELSE 0 END)
  + (CASE WHEN starts_with(extra_data, '0x') THEN length(extra_data) - 2 ELSE 0 END)), 0) AS BIGINT) AS hex_chars FROM blk)
SELECT hex_chars, hex_chars * 4 AS bit_count, CAST(hex_chars * 4 AS DOUBLE) / 8 AS byte_count FROM n""",
    "self_trades": DAY + """SELECT hash, from_address AS address, value, block_timestamp AS ts FROM tx
  WHERE from_address IS NOT DISTINCT FROM to_address""",
    "self_trade_summary": DAY + """SELECT from_address AS address, CAST(count(*) AS BIGINT) AS n_self_trades,
  CAST(sum(value) AS DECIMAL(38,0)) AS self_value, min(block_timestamp) AS first_ts, max(block_timestamp) AS last_ts
  FROM tx WHERE from_address IS NOT DISTINCT FROM to_address GROUP BY from_address""",
    "without_self_trades": DAY + "SELECT hash, from_address, to_address, value FROM tx WHERE from_address IS DISTINCT FROM to_address",
    "avg_transfer_value": DAY + ", " + NET + "SELECT * FROM stats",
    "net_positions": DAY + ", " + NET + "SELECT * FROM net",
    "net_neutral_accounts": DAY + ", " + NET
    + "SELECT address, net_value FROM net WHERE abs(net_value) < 0.15 * (SELECT avg_value FROM stats)",
    "net_neutral_count": DAY + ", " + NET
    + """SELECT CAST(count(*) AS BIGINT) AS n_candidates, (SELECT n_transfers FROM stats) AS n_transfers
  FROM net WHERE abs(net_value) < 0.15 * (SELECT avg_value FROM stats)""",
}


# --- transfer graph and SCC peeling ------------------------------------

EDGES = """SELECT from_address AS src, to_address AS dst, count(*) AS weight,
  CAST(sum(value) AS DECIMAL(38,0)) AS value FROM tx
  WHERE from_address IS DISTINCT FROM to_address AND from_address IS NOT NULL AND to_address IS NOT NULL
  GROUP BY 1, 2"""


def _graph(recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + f"tx AS ({b.TRANSFERS_GROUPS_SQL}),\ne AS ({EDGES})"


VERTICES = """, nonself AS (SELECT * FROM tx WHERE from_address IS DISTINCT FROM to_address),
v AS (SELECT address, min(token_type) AS token_type FROM (
  SELECT from_address AS address, token_type FROM nonself UNION ALL SELECT to_address, token_type FROM nonself)
  WHERE address IS NOT NULL GROUP BY address)
"""

COMPONENTS = """,
reach(s, d) AS (SELECT src, dst FROM e UNION SELECT r.s, e.dst FROM reach r JOIN e ON r.d = e.src),
mutual AS (SELECT a.s AS address, a.d AS other FROM reach a JOIN reach b ON a.s = b.d AND a.d = b.s WHERE a.s <> a.d),
comp AS (SELECT address, least(address, min(other)) AS component, count(*) + 1 AS n_members FROM mutual GROUP BY address)
"""

LEVELS = """,
lv AS (SELECT weight AS level_weight, weight - coalesce(lag(weight) OVER (ORDER BY weight), 0) AS multiplicity
       FROM (SELECT DISTINCT weight FROM e)),
le AS (SELECT lv.level_weight, e.src, e.dst FROM e JOIN lv ON e.weight >= lv.level_weight),
reach(l, s, d) AS (SELECT level_weight, src, dst FROM le
                   UNION SELECT r.l, r.s, le.dst FROM reach r JOIN le ON r.l = le.level_weight AND r.d = le.src),
mutual AS (SELECT a.l, a.s AS address, a.d AS other FROM reach a JOIN reach b
           ON a.l = b.l AND a.s = b.d AND a.d = b.s WHERE a.s <> a.d),
mem AS (SELECT l AS level_weight, address, least(address, min(other)) AS set_key, count(*) + 1 AS n_members
        FROM mutual GROUP BY l, address),
lsets AS (SELECT DISTINCT m.level_weight, m.set_key, m.n_members, lv.multiplicity FROM mem m JOIN lv USING (level_weight)),
occ AS (SELECT set_key, n_members, CAST(sum(multiplicity) AS BIGINT) AS occurrences,
        CAST(min(level_weight - multiplicity + 1) AS BIGINT) AS first_round, CAST(max(level_weight) AS BIGINT) AS last_round
        FROM lsets GROUP BY set_key, n_members),
members AS (SELECT DISTINCT set_key, n_members, address FROM mem),
cand AS (SELECT * FROM occ WHERE occurrences >= 3),
nonself AS (SELECT * FROM tx WHERE from_address IS DISTINCT FROM to_address),
legs AS (SELECT from_address AS address, -value AS amount FROM nonself
         UNION ALL SELECT to_address AS address, value AS amount FROM nonself),
net AS (SELECT address, CAST(sum(amount) AS DECIMAL(38,0)) AS net_value FROM legs GROUP BY address),
ps AS (SELECT m.set_key, m.n_members, CAST(coalesce(sum(n.net_value), 0) AS DECIMAL(38,0)) AS net_sum,
       CAST(coalesce(sum(abs(n.net_value)), 0) AS DECIMAL(38,0)) AS abs_sum,
       CAST(sum(n.net_value) AS DOUBLE) / count(n.net_value) AS net_mean
       FROM members m LEFT JOIN net n ON m.address = n.address GROUP BY 1, 2),
vm AS (SELECT c.*, ps.net_sum, ps.net_mean, ps.abs_sum,
       100 * CAST(abs(ps.net_sum) AS HUGEINT) <= CAST(ps.abs_sum AS HUGEINT) AS volume_matched
       FROM cand c LEFT JOIN ps USING (set_key, n_members)),
matched_members AS (SELECT m.* FROM members m JOIN vm USING (set_key, n_members) WHERE vm.volume_matched),
cand_members AS (SELECT m.* FROM members m JOIN cand USING (set_key, n_members))
"""

SET_EDGES = """SELECT ms.set_key, ms.n_members, e.src, e.dst, e.weight, e.value FROM e
  JOIN {m} ms ON e.src = ms.address
  JOIN {m} md ON md.set_key = ms.set_key AND md.n_members = ms.n_members AND e.dst = md.address"""

G, R = _graph(), _graph(True)

ORACLE.update({
    "graph_vertices": G + VERTICES + "SELECT address, token_type FROM v",
    "graph_edges": G + "\nSELECT * FROM e",
    "edge_peel": G + "\nSELECT src, dst, weight - 1 AS weight, value FROM e WHERE weight - 1 > 0",
    "vertices_with_edges": G + VERTICES + """SELECT address, token_type FROM v WHERE address IN (
  SELECT src FROM e WHERE weight > 1 UNION SELECT dst FROM e WHERE weight > 1)""",
    "scc_components": R + COMPONENTS + "SELECT address, component, n_members FROM comp",
    "scc_edges": R + COMPONENTS + """SELECT c1.component, c1.n_members, e.src, e.dst, e.weight, e.value
  FROM e JOIN comp c1 ON e.src = c1.address JOIN comp c2 ON e.dst = c2.address AND c1.component = c2.component""",
    "scc_occurrences": R + LEVELS + "SELECT * FROM occ",
    "scc_candidates": R + LEVELS + "SELECT * FROM cand",
    "scc_set_members": R + LEVELS + "SELECT set_key, n_members, address FROM members",
    "scc_volume_match": R + LEVELS + "SELECT * FROM vm",
    "wash_sets": R + LEVELS + """SELECT o.*, ps.net_sum, ps.net_mean, ps.abs_sum,
  100 * CAST(abs(ps.net_sum) AS HUGEINT) <= CAST(ps.abs_sum AS HUGEINT) AS volume_matched,
  o.occurrences >= 3 AS is_candidate FROM occ o LEFT JOIN ps USING (set_key, n_members)""",
    "wash_set_volume": R + LEVELS + f""", se AS ({SET_EDGES.format(m="cand_members")})
SELECT set_key, n_members, count(*) AS n_edges, CAST(sum(weight) AS BIGINT) AS n_transfers,
  CAST(sum(value) AS DECIMAL(38,0)) AS volume FROM se GROUP BY 1, 2""",
    "wash_suspects": R + LEVELS + "SELECT address, count(*) AS n_sets FROM matched_members GROUP BY address",
    "top_wash_trader": R + LEVELS + f""", we AS (SELECT DISTINCT src, dst, value FROM ({SET_EDGES.format(m="matched_members")})),
wv AS (SELECT address, CAST(sum(v) AS DECIMAL(38,0)) AS wash_volume FROM (
  SELECT src AS address, value AS v FROM we UNION ALL SELECT dst, value FROM we) GROUP BY address),
tv AS (SELECT address, CAST(sum(v) AS DECIMAL(38,0)) AS total_volume FROM (
  SELECT src AS address, value AS v FROM e UNION ALL SELECT dst, value FROM e) GROUP BY address)
SELECT wv.address, wv.wash_volume, tv.total_volume,
  CAST(wv.wash_volume AS DOUBLE) / NULLIF(CAST(tv.total_volume AS DOUBLE), 0) AS wash_share
  FROM wv LEFT JOIN tv USING (address) ORDER BY wash_volume DESC, address LIMIT 1""",
    "vertex_scc_counts": R + LEVELS + """SELECT m.address, CAST(sum(lv.multiplicity) AS BIGINT) AS n_rounds,
  count(DISTINCT (m.set_key, m.n_members)) AS n_sets FROM mem m JOIN lv USING (level_weight) GROUP BY m.address""",
    "reciprocal_pairs": G + """
SELECT x.src AS a, x.dst AS b, x.weight AS weight_ab, x.value AS value_ab, y.weight AS weight_ba, y.value AS value_ba
  FROM e x JOIN e y ON x.src = y.dst AND x.dst = y.src WHERE x.src < x.dst""",
})

ORACLE.update({
    "cycles_3": G + """
SELECT e1.src AS v1, e1.dst AS v2, e2.dst AS v3, least(e1.weight, e2.weight, e3.weight) AS min_weight
  FROM e e1 JOIN e e2 ON e1.dst = e2.src JOIN e e3 ON e2.dst = e3.src AND e3.dst = e1.src
  WHERE e1.src < e1.dst AND e1.src < e2.dst""",
    "cycles_4": G + """
SELECT e1.src AS v1, e1.dst AS v2, e2.dst AS v3, e3.dst AS v4,
  least(e1.weight, e2.weight, e3.weight, e4.weight) AS min_weight
  FROM e e1 JOIN e e2 ON e1.dst = e2.src JOIN e e3 ON e2.dst = e3.src
  JOIN e e4 ON e3.dst = e4.src AND e4.dst = e1.src
  WHERE e1.src < e1.dst AND e1.src < e2.dst AND e1.src < e3.dst AND e1.dst <> e3.dst""",
    "result_roundtrip": ORACLE["monthly_tx_count"],
    "result_roundtrip_csv": ORACLE["monthly_tx_count"],
    "result_roundtrip_text": ORACLE["monthly_tx_count"],
})

ORACLE["scc_member_match"] = R + LEVELS + f""", se AS ({SET_EDGES.format(m="cand_members")}),
inner_legs AS (SELECT set_key, n_members, src AS address, -value AS amount FROM se
         UNION ALL SELECT set_key, n_members, dst AS address, value AS amount FROM se),
pm AS (SELECT set_key, n_members, address, sum(amount) AS inner_net FROM inner_legs GROUP BY 1, 2, 3),
vol AS (SELECT set_key, n_members, CAST(sum(value) AS DECIMAL(38,0)) AS inner_volume FROM se GROUP BY 1, 2),
worst AS (SELECT set_key, n_members, CAST(max(abs(inner_net)) AS DECIMAL(38,0)) AS max_member_net FROM pm GROUP BY 1, 2)
SELECT c.*, vol.inner_volume, worst.max_member_net,
  100 * CAST(worst.max_member_net AS HUGEINT) <= CAST(vol.inner_volume AS HUGEINT) AS member_matched
  FROM cand c LEFT JOIN vol USING (set_key, n_members) LEFT JOIN worst USING (set_key, n_members)"""

ORACLE["read_ledger_csv"] = ORACLE["read_ledger_csv_no_header"] = ORACLE["clean_transactions"]
ORACLE["read_ledger_lines"] = f"SELECT * FROM ({ORACLE['clean_transactions']}) WHERE CAST(hash AS BIGINT) % 23 <> 0"
ORACLE["result_array"] = f"""SELECT CAST(row_number() OVER (ORDER BY month_start) - 1 AS INTEGER) AS pos, month, n_transactions
  FROM ({ORACLE['monthly_tx_count']}) ORDER BY pos LIMIT 100"""
ORACLE["first_months"] = f"SELECT * FROM ({ORACLE['monthly_tx_count']}) ORDER BY month_start LIMIT 12"

ORACLE["monthly_stream_count_sum"] = ORACLE["monthly_count_sum"]

ORACLE["monthly_raw_count"] = _with(raw=b.TX_RAW_SQL) + f"""
SELECT strftime(date_trunc('month', make_timestamp(CAST(trim(block_timestamp) AS BIGINT) * 1000000)), '%m-%Y') AS month,
  CAST(date_trunc('month', make_timestamp(CAST(trim(block_timestamp) AS BIGINT) * 1000000)) AS DATE) AS month_start,
  CAST(count(*) AS BIGINT) AS n_transactions
  FROM raw WHERE regexp_matches(block_timestamp, {INT_RE}) GROUP BY 1, 2"""
