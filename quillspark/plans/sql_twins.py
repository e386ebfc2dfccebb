"""DuckDB twins of the multi-step operators, used as correctness oracles.

Where the Spark side avoids enumeration (unranking, keyed index joins), the
twin enumerates on purpose: every allowed pair gets its canonical ordinal by
``row_number`` and the keyed ordinal picks one. Agreement therefore checks the
unranking arithmetic, not just a re-typing of the same plan.
"""

from __future__ import annotations

from quillspark.functions import key_sql
from quillspark.operators.splits import split_authors_sql
from quillspark.sources.views import posts_sql


def forum_posts_sql(fine: bool = True, lo: int = 25, hi: int = 1000, min_n: int = 2, max_n: int = 1000) -> str:
    """posts view -> B3 (lo < words < hi) -> B10 (min_n..max_n posts per author)."""
    return f"""
    SELECT * FROM (SELECT * FROM ({posts_sql(fine)}) p0 WHERE text_length > {lo} AND text_length < {hi}) p1
    WHERE author IN (SELECT author FROM (SELECT * FROM ({posts_sql(fine)}) p0 WHERE text_length > {lo} AND text_length < {hi}) p2
                     GROUP BY author HAVING count(*) >= {min_n} AND count(*) <= {max_n})"""


def positives_by_domain_sql(posts_rel: str, mode: str = "in_domain", m: int = 5, seed: int = 42) -> str:
    """Twin of ``pairs.positive_pairs_by_domain``: all pairs of a user are listed and numbered; draws are applied one after the
    other, each as a position in the list of numbers that are still free."""
    cond, order = ("a.domain = b.domain AND a.dord < b.dord", "d, e, j, i") if mode == "in_domain" else ("a.domain < b.domain", "d, e, i, j")
    return f"""
    WITH RECURSIVE p AS ({posts_rel}),
    users AS ({split_authors_sql('SELECT author FROM p', 'author', seed)}),
    ix AS (SELECT p.author, p.post_id, p.domain, u.split, row_number() OVER (PARTITION BY p.author, p.domain ORDER BY p.post_id) - 1 AS dord
           FROM p JOIN users u ON p.author = u.author),
    combos AS (SELECT a.split, a.author, a.domain AS d, b.domain AS e, a.dord AS i, b.dord AS j, a.post_id AS pa, b.post_id AS pb
               FROM ix a JOIN ix b ON a.author = b.author AND {cond}),
    co AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY {order}) - 1 AS o, count(*) OVER (PARTITION BY author) AS T FROM combos),
    tot AS (SELECT DISTINCT author, T FROM co),
    dr AS (SELECT author, T, 0 AS slot, generate_series(0, T - 1) AS free, CAST(NULL AS BIGINT) AS o FROM tot
           UNION ALL
           SELECT author, T, slot + 1, list_filter(free, lambda x: x <> pick), pick FROM (
             SELECT *, CASE WHEN T <= {m} THEN slot ELSE free[{key_sql(seed, 'pos', mode, '@author', '@slot')} % len(free) + 1] END AS pick
             FROM dr WHERE slot < least(T, {m})) q)
    SELECT co.split, true AS label, co.author AS author_a, least(pa, pb) AS post_id_a, co.author AS author_b, greatest(pa, pb) AS post_id_b,
           CAST(dr.slot - 1 AS BIGINT) AS slot FROM dr JOIN co ON co.author = dr.author AND co.o = dr.o WHERE dr.slot > 0"""


def pairs_by_domain_sql(posts_rel: str, mode: str = "in_domain", attempts: int = 8, seed: int = 42) -> str:
    """Twin of ``pairs.pairs_by_domain`` (max 2 positives per user)."""
    if mode == "in_domain":
        pos_cond = "a.domain = b.domain AND a.dord < b.dord"
        pos_order = "d, e, j, i"
        neg_cond = "x.domain = y.domain"
    else:
        pos_cond = "a.domain < b.domain"
        pos_order = "d, e, i, j"
        neg_cond = "x.domain <> y.domain"
    k0 = key_sql(seed, "pos", mode, "@author", "0")
    k1 = key_sql(seed, "pos", mode, "@author", "1")
    ka = key_sql(seed, "neg", mode, "a", "@anchor", "@slot", "@t")
    kb = key_sql(seed, "neg", mode, "b", "@anchor", "@slot", "@t")
    kp = key_sql(seed, "neg", mode, "pick", "@c.anchor", "@c.slot", "@c.t")
    return f"""
    WITH p AS ({posts_rel}),
    users AS ({split_authors_sql('SELECT author FROM p', 'author', seed)}),
    ix AS (SELECT p.author, p.post_id, p.domain, u.split,
                  row_number() OVER (PARTITION BY p.author, p.domain ORDER BY p.post_id) - 1 AS dord
           FROM p JOIN users u ON p.author = u.author),
    combos AS (SELECT a.split, a.author, a.domain AS d, b.domain AS e, a.dord AS i, b.dord AS j,
                      a.post_id AS pa, b.post_id AS pb
               FROM ix a JOIN ix b ON a.author = b.author AND {pos_cond}),
    co AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY {pos_order}) - 1 AS o,
                  count(*) OVER (PARTITION BY author) AS T FROM combos),
    dr AS (SELECT DISTINCT author, T, {k0} % T AS o1,
                  CASE WHEN T > 1 THEN {k1} % (T - 1) END AS raw1 FROM co),
    draws AS (SELECT author, 0 AS slot, CASE WHEN T <= 2 THEN 0 ELSE o1 END AS o FROM dr
              UNION ALL
              SELECT author, 1 AS slot, CASE WHEN T <= 2 THEN 1 ELSE raw1 + CASE WHEN raw1 >= o1 THEN 1 ELSE 0 END END AS o
              FROM dr WHERE T >= 2),
    pos AS (SELECT co.split, co.author, co.pa, co.pb, draws.slot FROM co JOIN draws ON co.author = draws.author AND co.o = draws.o),
    un AS (SELECT split, count(*) AS split_n FROM users GROUP BY split),
    att AS (SELECT pos.split, pos.author AS anchor, pos.slot, t.t, un.split_n
            FROM pos JOIN un ON pos.split = un.split CROSS JOIN range(0, {attempts}) t(t) WHERE un.split_n >= 2),
    att2 AS (SELECT *, {ka} % split_n AS ia, {kb} % (split_n - 1) AS ib0 FROM att),
    att3 AS (SELECT split, anchor, slot, t, ia, ib0 + CASE WHEN ib0 >= ia THEN 1 ELSE 0 END AS ib FROM att2),
    att4 AS (SELECT a.split, a.anchor, a.slot, a.t, ua.author AS ua, ub.author AS ub FROM att3 a
             JOIN users ua ON ua.split = a.split AND ua.split_idx = a.ia
             JOIN users ub ON ub.split = a.split AND ub.split_idx = a.ib),
    cand AS (SELECT att4.*, x.domain AS d, y.domain AS e, x.dord AS i, y.dord AS j, x.post_id AS pa, y.post_id AS pb
             FROM att4 JOIN ix x ON x.author = att4.ua JOIN ix y ON y.author = att4.ub AND {neg_cond}),
    cand2 AS (SELECT *, row_number() OVER (PARTITION BY split, anchor, slot, t ORDER BY d, e, i, j) - 1 AS o,
                     count(*) OVER (PARTITION BY split, anchor, slot, t) AS W FROM cand),
    firstok AS (SELECT split, anchor, slot, min(t) AS t FROM cand2 GROUP BY split, anchor, slot),
    neg AS (SELECT c.* FROM cand2 c JOIN firstok f ON c.split = f.split AND c.anchor = f.anchor AND c.slot = f.slot
            AND c.t = f.t WHERE c.o = {kp} % c.W)
    SELECT split, true AS label, author AS author_a, least(pa, pb) AS post_id_a, author AS author_b,
           greatest(pa, pb) AS post_id_b, CAST(slot AS BIGINT) AS slot, author AS anchor FROM pos
    UNION ALL
    SELECT split, false AS label, ua AS author_a, pa AS post_id_a, ub AS author_b, pb AS post_id_b,
           CAST(slot AS BIGINT) AS slot, anchor FROM neg"""


def pairs_random_sql(posts_rel: str, seed: int = 42, p: int = 2, q: int = 2) -> str:
    """Twin of ``pairs.pairs_random`` (negatives inside the split)."""
    kpi = key_sql(seed, "f5", "pi", "@pd.author", "@pd.slot")
    kpj = key_sql(seed, "f5", "pj", "@pd.author", "@pd.slot")
    kni = key_sql(seed, "f5", "ni", "@nd.author", "@nd.slot")
    knb = key_sql(seed, "f5", "nb", "@nd.author", "@nd.slot")
    knj = key_sql(seed, "f5", "nj", "@nd3.author", "@nd3.slot")
    return f"""
    WITH p AS ({posts_rel}),
    users AS ({split_authors_sql('SELECT author FROM p', 'author', seed)}),
    ix AS (SELECT author, post_id, row_number() OVER (PARTITION BY author ORDER BY post_id) - 1 AS tord FROM p),
    au AS (SELECT u.*, n.n_texts FROM users u JOIN (SELECT author, count(*) AS n_texts FROM p GROUP BY author) n ON u.author = n.author),
    pd AS (SELECT au.*, s.slot FROM au CROSS JOIN range(0, {p}) s(slot) WHERE n_texts >= 2),
    pd2 AS (SELECT pd.*, {kpi} % n_texts AS ia, {kpj} % (n_texts - 1) AS j0 FROM pd),
    pos AS (SELECT pd2.split, true AS label, pd2.author AS author_a, a.post_id AS post_id_a, pd2.author AS author_b,
                   b.post_id AS post_id_b, CAST(pd2.slot AS BIGINT) AS slot
            FROM pd2 JOIN ix a ON a.author = pd2.author AND a.tord = pd2.ia
            JOIN ix b ON b.author = pd2.author AND b.tord = pd2.j0 + CASE WHEN pd2.j0 >= pd2.ia THEN 1 ELSE 0 END),
    nd AS (SELECT au.*, s.slot FROM au CROSS JOIN range(0, {q}) s(slot) WHERE split_n >= 2),
    nd2 AS (SELECT nd.*, {kni} % n_texts AS ia, {knb} % (split_n - 1) AS b0 FROM nd),
    nd3 AS (SELECT nd2.*, o.author AS author_b, o.n_texts AS n_b FROM nd2 JOIN au o ON o.split = nd2.split
            AND o.split_idx = nd2.b0 + CASE WHEN nd2.b0 >= nd2.split_idx THEN 1 ELSE 0 END),
    neg AS (SELECT nd3.split, false AS label, nd3.author AS author_a, a.post_id AS post_id_a, nd3.author_b,
                   b.post_id AS post_id_b, CAST(nd3.slot AS BIGINT) AS slot
            FROM nd3 JOIN ix a ON a.author = nd3.author AND a.tord = nd3.ia
            JOIN ix b ON b.author = nd3.author_b AND b.tord = {knj} % nd3.n_b)
    SELECT * FROM pos UNION ALL SELECT * FROM neg"""


def pairs_per_text_sql(aa_rel: str, passes: int = 1, mode: str = "both", seed: int = 42) -> str:
    """Twin of ``pairs.pairs_per_text``."""
    kcoin = key_sql(seed, "coin", "@pass", "@text_id")
    kj = key_sql(seed, "ppt", "same", "@pass", "@text_id")
    kb = key_sql(seed, "ppt", "other", "@pass", "@text_id")
    ko = key_sql(seed, "ppt", "otext", "@pass", "@text_id")
    if mode == "both":
        rows = "SELECT t.*, 1 AS label FROM t WHERE n_texts >= 2 UNION ALL SELECT t.*, 0 AS label FROM t WHERE n_texts >= 2"
    else:
        rows = f"SELECT t.*, CAST({kcoin} % 2 AS INTEGER) AS label FROM t WHERE n_texts >= 2 OR {kcoin} % 2 = 0"
    return f"""
    WITH a AS (SELECT author_id AS author, text_id FROM ({aa_rel}) r),
    ix AS (SELECT author, text_id, row_number() OVER (PARTITION BY author ORDER BY text_id) - 1 AS tord FROM a),
    au AS (SELECT author, row_number() OVER (ORDER BY min(text_id), author) - 1 AS aidx, count(*) AS n_texts FROM a GROUP BY author),
    na AS (SELECT count(*) AS A FROM au),
    t AS (SELECT ix.*, au.aidx, au.n_texts, na.A, ps.pass FROM ix JOIN au ON ix.author = au.author CROSS JOIN na
          CROSS JOIN range(0, {passes}) ps(pass)),
    rw AS ({rows}),
    r2 AS (SELECT * FROM rw WHERE label = 1 OR A >= 2),
    r3 AS (SELECT *, CASE WHEN label = 1 THEN {kj} % (n_texts - 1) END AS kj,
                     CASE WHEN label = 0 THEN {kb} % (A - 1) END AS kb FROM r2),
    r4 AS (SELECT *, CASE WHEN label = 1 THEN kj + CASE WHEN kj >= tord THEN 1 ELSE 0 END END AS jb,
                     CASE WHEN label = 0 THEN kb + CASE WHEN kb >= aidx THEN 1 ELSE 0 END END AS ob FROM r3),
    r5 AS (SELECT r4.*, CASE WHEN r4.label = 1 THEN r4.author ELSE o.author END AS author_b, o.n_texts AS n_o
           FROM r4 LEFT JOIN au o ON o.aidx = r4.ob),
    r6 AS (SELECT *, CASE WHEN label = 1 THEN jb ELSE {ko} % n_o END AS jb2 FROM r5)
    SELECT CAST(r6.pass AS BIGINT) AS pass, r6.text_id AS text_id_a, r6.author AS author_a, x.text_id AS text_id_b,
           r6.author_b, CAST(r6.label AS INTEGER) AS label
    FROM r6 JOIN ix x ON x.author = r6.author_b AND x.tord = r6.jb2"""


def check_corpus_sql(strat_rel: str) -> str:
    """Twin of ``checks.check_corpus`` over a stratified split with train-learnt dense labels."""
    return f"""
    WITH s AS ({strat_rel}),
    ids AS (SELECT author, row_number() OVER (ORDER BY min(post_id), author) - 1 AS author_id FROM s WHERE split = 'train' GROUP BY author),
    x AS (SELECT s.*, ids.author_id FROM s LEFT JOIN ids ON s.author = ids.author),
    na AS (SELECT count(DISTINCT author_id) AS A FROM x WHERE split = 'train')
    SELECT 'labels_dense' AS "check", CAST(count_if(author_id IS NULL OR author_id < 0 OR author_id >= na.A) AS BIGINT) AS n_bad
      FROM x, na WHERE split = 'train' GROUP BY na.A
    UNION ALL
    SELECT 'eval_labels_in_train', CAST(count(*) AS BIGINT) FROM x WHERE split <> 'train'
      AND (author_id IS NULL OR author_id NOT IN (SELECT author_id FROM x WHERE split = 'train' AND author_id IS NOT NULL))
    UNION ALL
    SELECT 'text_in_two_splits', CAST(count_if(ns > 1) AS BIGINT) FROM (SELECT text, count(DISTINCT split) AS ns FROM x GROUP BY text) t"""


def profile_pairs_sql(posts_rel: str, seed: int = 42, min_tokens: int = 25, min_ratio: float = 0.3, max_ratio: float = 0.7,
                      tries: int = 10, buckets: int = 10) -> str:
    """Twin of ``profiles.profile_split`` + ``profiles.pairs_profile``: candidates
    are enumerated (positives x halves) and ordered by (len, author, side)."""
    from quillspark.functions import unit_sql
    from quillspark.functions import text as T
    k = key_sql(seed, "prof", "@author", "@post_id")
    u = unit_sql(seed, "target", "@per.author", "@r.r")
    kn = key_sql(seed, "profneg", "@c.split", "@c.author")
    qs = ", ".join(f"({i}, CAST({i / buckets!r} AS DOUBLE))" for i in range(buckets + 1))
    return f"""
    WITH p0 AS ({posts_rel}),
    p AS (SELECT split, author, post_id, text, {T.word_count_sql('text')} AS tok, {k} AS k FROM p0),
    po AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY k, post_id) - 1 AS o FROM p),
    pa AS (SELECT *, sum(tok) OVER (PARTITION BY author ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acc FROM po),
    per AS (SELECT split, author, count(*) AS n, sum(tok) AS T FROM pa GROUP BY split, author HAVING count(*) >= 2),
    tr AS (SELECT per.*, r.r, (CAST({min_ratio!r} AS DOUBLE) + CAST({max_ratio - min_ratio!r} AS DOUBLE) * {u}) * CAST(per.T AS DOUBLE) AS target
           FROM per CROSS JOIN range(0, {tries}) r(r)),
    cuts AS (SELECT tr.author, first(pa.o + 1 ORDER BY tr.r, pa.o) AS sp_try FROM tr JOIN pa ON pa.author = tr.author
             WHERE pa.o < tr.n - 1 AND CAST(pa.acc AS DOUBLE) >= tr.target AND pa.acc >= {min_tokens} AND tr.T - pa.acc >= {min_tokens}
             GROUP BY tr.author),
    sp AS (SELECT per.split, per.author, CASE WHEN per.n = 2 THEN 1 ELSE coalesce(cuts.sp_try, per.n // 2) END AS sp
           FROM per LEFT JOIN cuts ON per.author = cuts.author),
    halves AS (SELECT pa.split, pa.author, CASE WHEN pa.o < sp.sp THEN 'a' ELSE 'b' END AS side,
                      CAST(sum(pa.tok) + count(*) - 1 AS BIGINT) AS len
               FROM pa JOIN sp ON pa.author = sp.author GROUP BY pa.split, pa.author, side),
    pos AS (SELECT a.split, a.author, a.len AS len_a, b.len AS len_b,
                   abs(CAST(a.len AS DOUBLE) - CAST(b.len AS DOUBLE)) / CAST(a.len + b.len AS DOUBLE) AS diff
            FROM halves a JOIN halves b ON a.author = b.author AND a.side = 'a' AND b.side = 'b'),
    ranked AS (SELECT split, diff, row_number() OVER (PARTITION BY split ORDER BY diff) - 1 AS o, count(*) OVER (PARTITION BY split) AS n FROM pos),
    qd AS (SELECT s.split, s.n, q.qi, q.q, q.q * CAST(s.n - 1 AS DOUBLE) AS h FROM (SELECT DISTINCT split, n FROM ranked) s
           CROSS JOIN (VALUES {qs}) q(qi, q)),
    qv AS (SELECT qd.split, qd.qi, CASE WHEN qd.h - floor(qd.h) >= 0.5 THEN hi.diff - (hi.diff - lo.diff) * (CAST(1 AS DOUBLE) - (qd.h - floor(qd.h)))
                                  ELSE lo.diff + (hi.diff - lo.diff) * (qd.h - floor(qd.h)) END AS value
           FROM qd JOIN ranked lo ON lo.split = qd.split AND lo.o = CAST(floor(qd.h) AS BIGINT)
           JOIN ranked hi ON hi.split = qd.split AND hi.o = CAST(ceil(qd.h) AS BIGINT)),
    pb AS (SELECT pos.*, least({buckets - 1}, greatest(0, (SELECT count(*) FROM qv WHERE qv.split = pos.split AND qv.value <= pos.diff) - 1)) AS bucket FROM pos),
    pq AS (SELECT pb.*, l.value AS lo, h.value AS hi FROM pb JOIN qv l ON l.split = pb.split AND l.qi = pb.bucket
           JOIN qv h ON h.split = pb.split AND h.qi = pb.bucket + 1),
    cand AS (SELECT pq.split, pq.author, pq.len_a, h.author AS author_b, h.side AS side_b, h.len AS len_b2,
                    abs(CAST(pq.len_a AS DOUBLE) - CAST(h.len AS DOUBLE)) / CAST(pq.len_a + h.len AS DOUBLE) AS d, pq.lo, pq.hi
             FROM pq JOIN halves h ON h.split = pq.split AND h.author <> pq.author),
    cnt AS (SELECT split, author, count_if(d >= lo AND d <= hi) AS C, count(*) AS NO FROM cand GROUP BY split, author),
    c AS (SELECT cand.*, cnt.C, cnt.NO FROM cand JOIN cnt ON cand.split = cnt.split AND cand.author = cnt.author
          WHERE (cnt.C > 0 AND cand.d >= cand.lo AND cand.d <= cand.hi) OR cnt.C = 0),
    c2 AS (SELECT c.*, row_number() OVER (PARTITION BY c.split, c.author ORDER BY c.len_b2, c.author_b, c.side_b) - 1 AS ord,
                  CASE WHEN c.C > 0 THEN c.C ELSE c.NO END AS pool FROM c),
    neg AS (SELECT * FROM c2 c WHERE ord = {kn} % pool)
    SELECT split, true AS label, author AS author_a, 'a' AS side_a, author AS author_b, 'b' AS side_b, len_a, len_b FROM pos
    UNION ALL
    SELECT split, false AS label, author AS author_a, 'a' AS side_a, author_b, side_b, len_a, len_b2 AS len_b FROM neg"""


def sample_episodes_sql(aa_rel: str, n_way: int, k_shot: int, episodes: int, seed: int = 42) -> str:
    """Twin of ``pairs.sample_episodes``: every draw takes a position in the list of authors, or of an author's texts, still free."""
    return f"""
    WITH RECURSIVE a AS (SELECT author_id, text_id, row_number() OVER (PARTITION BY author_id ORDER BY text_id) - 1 AS tord,
                                count(*) OVER (PARTITION BY author_id) AS n FROM ({aa_rel}) r),
    ids AS (SELECT author_id, max(n) AS n, row_number() OVER (ORDER BY min(text_id), author_id) - 1 AS aidx FROM a WHERE n >= {2 * k_shot} GROUP BY author_id),
    ep AS (SELECT episode, 0 AS slot, generate_series(0, (SELECT count(*) FROM ids) - 1) AS free, CAST(NULL AS BIGINT) AS pick
           FROM range(0, {episodes}) e(episode) WHERE (SELECT count(*) FROM ids) >= {n_way}
           UNION ALL
           SELECT episode, slot + 1, list_filter(free, lambda x: x <> p), p FROM (
             SELECT *, free[{key_sql(seed, 'ep', '@episode', '@slot')} % len(free) + 1] AS p FROM ep WHERE slot < {n_way}) q),
    au AS (SELECT episode, slot - 1 AS label, author_id, n FROM ep JOIN ids ON ids.aidx = ep.pick WHERE slot > 0),
    tx AS (SELECT episode, label, author_id, 0 AS slot, generate_series(0, n - 1) AS free, CAST(NULL AS BIGINT) AS pick FROM au
           UNION ALL
           SELECT episode, label, author_id, slot + 1, list_filter(free, lambda x: x <> p), p FROM (
             SELECT *, free[{key_sql(seed, 'shot', '@episode', '@author_id', '@slot')} % len(free) + 1] AS p FROM tx WHERE slot < {2 * k_shot}) q)
    SELECT CAST(episode AS BIGINT) AS episode, CAST(label AS INTEGER) AS label, tx.author_id, a.text_id,
      CASE WHEN slot <= {k_shot} THEN 'adapt' ELSE 'evaluate' END AS role
    FROM tx JOIN a ON a.author_id = tx.author_id AND a.tord = tx.pick WHERE slot > 0"""
