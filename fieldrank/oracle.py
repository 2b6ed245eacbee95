r"""DuckDB twins of the registered queries (the correctness oracle).

Every statement reads only the pre-registered base tables and derives the same views as
``sources/tables.py`` with the same rules. Helpers below assemble ``WITH`` clauses from
named CTE pieces; ``lg(x)`` is the logify rule ``1 + ln(x)`` for x > 0 else 0.
DuckDB spelling notes: ``ln`` (not ``log``), ``lambda x: ...`` lambdas, ``'g'`` flag for a
global regexp_replace, 1-based ``generate_subscripts``.
"""

from __future__ import annotations

from fieldrank.params import BM25FParams, CosineWeights, WindowBoost


def lg(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN 1 + ln({x}) ELSE 0.0 END)"


def toks(expr: str, lower: bool = False) -> str:
    e = f"lower({expr})" if lower else expr
    return f"list_filter(string_split_regex(coalesce({e}, ''), '\\s+'), lambda x: x <> '')"


def url_toks(expr: str) -> str:
    return f"list_filter(string_split_regex(coalesce({expr}, ''), '\\W'), lambda x: x <> '')"


WORD = r"[\p{L}\p{N}_]+"


def norm_text(expr: str) -> str:
    return f"array_to_string(regexp_extract_all({expr}, '{WORD}'), ' ')"


def runs(words: str, n: int) -> str:
    """The runs of n consecutive words, as strings."""
    return (f"(CASE WHEN len({words}) >= {n} THEN list_transform(range(1, len({words}) - {n} + 2), "
            f"lambda i: array_to_string({words}[i:i + {n} - 1], ' ')) ELSE []::VARCHAR[] END)")


# ---------------------------------------------------------------------------- base views
BASE = {
    "fx_sent": r"""SELECT item_id, unnest(s) AS sent, generate_subscripts(s, 1) - 1 AS sno
        FROM (SELECT item_id, string_split_regex(text, '[.!?\n]+') AS s FROM benchmark)""",
    "fx_queries": f"""SELECT item_id || '-' || sno AS query_id,
        array_to_string(regexp_extract_all(lower(sent), '{WORD}'), ' ') AS query
        FROM fx_sent WHERE len(regexp_extract_all(lower(sent), '{WORD}')) > 0""",
    "q_run": f"""SELECT DISTINCT query_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE {runs('w', 4)} END) AS run
        FROM (SELECT query_id, string_split(query, ' ') AS w FROM fx_queries)""",
    "q_tok": f"""SELECT query_id, unnest(t) AS term, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS qpos
        FROM (SELECT query_id, {toks('query', True)} AS t FROM fx_queries)""",
    "q_stats": """SELECT query_id, CAST(count(*) AS INTEGER) AS qlen, CAST(count(DISTINCT term) AS INTEGER) AS k
        FROM q_tok GROUP BY query_id""",
    "q_terms": """SELECT query_id, term, count(*) AS n FROM q_tok GROUP BY query_id, term""",
    "d_tok": f"""SELECT DISTINCT doc_id, unnest({toks('text')}) AS term FROM documents""",
    "d_n": """SELECT count(*) + 1 AS n_total FROM documents""",
    "q_idf": """SELECT q.query_id, q.term, q.n, CAST(coalesce(d.df, 0) AS BIGINT) AS df,
        ln((SELECT n_total FROM d_n)) - ln(coalesce(d.df, 0) + 1) AS idf,
        (1 + ln(q.n)) * (ln((SELECT n_total FROM d_n)) - ln(coalesce(d.df, 0) + 1)) AS qw
        FROM q_terms q LEFT JOIN (SELECT term, count(*) AS df FROM d_tok
                                  WHERE term IN (SELECT term FROM q_terms) GROUP BY term) d USING (term)""",
    "q_norm": """SELECT query_id, sum(abs(qw)) AS n1 FROM q_idf GROUP BY query_id""",
    # pages collection
    "pg_coll": f"""SELECT page_id, url,
        {norm_text("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
        list_transform(regexp_extract_all(html, '<h1>([^<]*)</h1>', 1), lambda x: {norm_text('x')}) AS headers,
        regexp_extract_all(lower(regexp_replace(html, '<[^>]*>', ' ', 'g')), '{WORD}') AS body_tokens,
        list_filter(list_transform(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1),
                                   lambda x: {norm_text('x')}), lambda x: x <> '') AS links,
        CAST(page_id % 11 AS INTEGER) AS pagerank, CAST(NULL AS DOUBLE) AS rel
        FROM pages""",
    "pg_anch": """SELECT page_id, text, CAST(count(*) + any_value(page_id % 5) AS INTEGER) AS cnt
        FROM (SELECT page_id, unnest(links) AS text FROM pg_coll) GROUP BY page_id, text""",
    "pg_run": f"""SELECT DISTINCT page_id, unnest({' || '.join(runs('body_tokens', n) for n in range(1, 5))}) AS run FROM pg_coll""",
    "pg_cand": "SELECT DISTINCT query_id, page_id FROM pg_run JOIN q_run USING (run)",
    "pg_body": "SELECT page_id, unnest(body_tokens) AS term, generate_subscripts(body_tokens, 1) AS pos FROM pg_coll",
    "pg_len": "SELECT page_id, CAST(len(body_tokens) AS DOUBLE) AS body_length FROM pg_coll",
    # judged pages: those with a label of their id
    "dc_coll": """SELECT c.* EXCLUDE (rel), CAST(2 * l.quality - l.toxic AS DOUBLE) AS rel
        FROM pg_coll c JOIN labels l ON l.doc_id = c.page_id""",
    "dc_anch": "SELECT a.* FROM pg_anch a SEMI JOIN dc_coll USING (page_id)",
    "dc_cand": "SELECT c.* FROM pg_cand c SEMI JOIN dc_coll USING (page_id)",
    "dc_body": "SELECT b.* FROM pg_body b SEMI JOIN dc_coll USING (page_id)",
    "dc_len": "SELECT b.* FROM pg_len b SEMI JOIN dc_coll USING (page_id)",
    # feature records of the page candidates of each distinct query text, and per query one
    # record without any token; page_id names the record, tie is its place in the query
    "fr_q": "SELECT query, min(query_id) AS query_id FROM fx_queries GROUP BY query",
    "fr_rec": """SELECT q.query_id, q.query, c.page_id AS page, q.query_id || '#' || c.page_id AS page_id,
          row_number() OVER (PARTITION BY q.query_id ORDER BY c.page_id) - 1 AS tie FROM pg_cand c JOIN fr_q q USING (query_id)""",
    "fr_none": """SELECT query_id, query, query_id || '#' AS page_id, max(tie) + 1 AS tie FROM fr_rec GROUP BY query_id, query""",
    "fr_cand": "SELECT query_id, page_id, tie FROM fr_rec UNION ALL SELECT query_id, page_id, tie FROM fr_none",
    "fr_coll": """SELECT r.page_id, c.url, c.title, c.headers, c.pagerank, c.rel FROM fr_rec r JOIN pg_coll c ON c.page_id = r.page
        UNION ALL SELECT page_id, '///', '', []::VARCHAR[], 0, NULL FROM fr_none""",
    "fr_anch": "SELECT r.page_id, a.text, a.cnt FROM fr_rec r JOIN pg_anch a ON a.page_id = r.page",
    "fr_len": "SELECT r.page_id, l.body_length FROM fr_rec r JOIN pg_len l ON l.page_id = r.page",
    "fr_body": """SELECT r.page_id, b.term, b.pos FROM fr_rec r JOIN pg_body b ON b.page_id = r.page
          JOIN q_terms q ON q.query_id = r.query_id AND q.term = b.term
        UNION ALL SELECT page_id, 'zz_listed', unnest([3, 7]) FROM fr_rec WHERE page % 5 = 0""",
}


def _collection(p: str) -> dict[str, str]:
    """Index CTEs of collection ``p`` (``pg`` pages, ``dc`` judged documents)."""
    c, a = f"{p}_coll", f"{p}_anch"
    return {
        # lowercase-view tokens; fld separates the window fields (one per anchor text)
        f"{p}_tok": f"""
            SELECT page_id, 'url' AS f, 'url' AS fld, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS pos, 1 AS c
              FROM (SELECT page_id, {url_toks('url')} AS t FROM {c})
            UNION ALL SELECT page_id, 'title', 'title', unnest(t), generate_subscripts(t, 1) - 1, 1
              FROM (SELECT page_id, {toks('title', True)} AS t FROM {c})
            UNION ALL SELECT page_id, 'header', 'header', unnest(t), generate_subscripts(t, 1) - 1, 1
              FROM (SELECT page_id, flatten(list_transform(headers, lambda h: {toks('h', True)})) AS t FROM {c})
            UNION ALL SELECT page_id, 'body', 'body', term, pos, 1 FROM {p}_body
            UNION ALL SELECT page_id, 'anchor', 'anchor:' || text, unnest(t), generate_subscripts(t, 1) - 1,
                             greatest(cnt, 1)
              FROM (SELECT page_id, text, cnt, {toks('text', True)} AS t FROM {a})""",
        f"{p}_rawtok": f"""
            SELECT page_id, 'title_raw' AS f, unnest({toks('title')}) AS term FROM {c}
            UNION ALL SELECT page_id, 'header_raw', unnest(flatten(list_transform(headers, lambda h: {toks('h')})))
              FROM {c}
            UNION ALL SELECT page_id, 'anchor_raw', unnest({toks('text')}) FROM {a}""",
        f"{p}_pt": f"""
            SELECT page_id, term,
              sum(CASE WHEN f = 'url' THEN c ELSE 0 END) AS tf_url,
              sum(CASE WHEN f = 'title' THEN c ELSE 0 END) AS tf_title,
              sum(CASE WHEN f = 'header' THEN c ELSE 0 END) AS tf_header,
              sum(CASE WHEN f = 'body' THEN c ELSE 0 END) AS tf_body,
              sum(CASE WHEN f = 'anchor' THEN c ELSE 0 END) AS tf_anchor,
              sum(CASE WHEN f = 'title_raw' THEN c ELSE 0 END) AS rtf_title,
              sum(CASE WHEN f = 'header_raw' THEN c ELSE 0 END) AS rtf_header,
              sum(CASE WHEN f = 'anchor_raw' THEN c ELSE 0 END) AS rtf_anchor
            FROM (SELECT page_id, f, term, c FROM {p}_tok
                  UNION ALL SELECT page_id, f, term, 1 FROM {p}_rawtok)
            GROUP BY page_id, term""",
        f"{p}_ps": f"""
            SELECT c.page_id, c.url, greatest(1000.0, coalesce(n.body_length, 1.0)) AS L,
              coalesce(n.body_length, 0) AS body_len_raw, coalesce(c.pagerank, 0) AS pagerank,
              CAST(len({url_toks('c.url')}) AS DOUBLE) AS len_url,
              CAST(len({toks('c.title')}) AS DOUBLE) AS len_title,
              CAST(len(flatten(list_transform(c.headers, lambda h: {toks('h')}))) AS DOUBLE) AS len_header,
              CAST(greatest(len(c.headers), 1) AS DOUBLE) AS n_header_d,
              CAST(coalesce(an.len_anchor, 0) AS DOUBLE) AS len_anchor,
              CAST(greatest(coalesce(an.n_anchor, 0), 1) AS DOUBLE) AS n_anchor_d, c.rel
            FROM {c} c LEFT JOIN {p}_len n USING (page_id) LEFT JOIN (SELECT page_id, sum(len({toks('text')})) AS len_anchor, count(*) AS n_anchor
                                   FROM {a} GROUP BY page_id) an USING (page_id)""",
        # matched query-term rows, with page scalars
        f"{p}_m": f"""SELECT q.query_id, q.n, q.idf, q.qw, t.*, ps.* EXCLUDE (page_id)
            FROM {p}_cand x JOIN q_idf q USING (query_id) JOIN {p}_pt t ON t.page_id = x.page_id AND t.term = q.term
            JOIN {p}_ps ps ON ps.page_id = x.page_id""",
    }


def pairs_cte(p: str, w: CosineWeights = CosineWeights(), name: str | None = None, normalize: bool = True,
              logify: bool = True) -> dict[str, str]:
    lg = globals()["lg"] if logify else (lambda x: f"CAST({x} AS DOUBLE)")
    L = " / L" if normalize else ""
    qw = "qw" if logify else "n * idf"
    s = (f"{w.url} * {lg('tf_url' + L)} + {w.title} * {lg('tf_title' + L)} + "
         f"{w.header} * {lg('tf_header' + L)} + {w.anchor} * {lg('tf_anchor' + L)}")
    b = f"(CASE WHEN tf_body > 0 THEN {w.body} * {lg('tf_body' + L)} END)"
    nm = name or f"{p}_pairs"
    # the literal norm: all terms of the page, body terms as far as the pair lists them
    listed = "true" if p == "fr" else "q.term IS NOT NULL"
    tie = "x.tie" if p == "fr" else "x.page_id"
    return {
        f"{nm}_L1": f"""SELECT x.query_id, x.page_id, sum(abs({s} + CASE WHEN {listed} THEN coalesce({b}, 0.0) ELSE 0.0 END)) AS L1
            FROM {p}_cand x JOIN {p}_pt t USING (page_id) JOIN (SELECT page_id, L FROM {p}_ps) USING (page_id)
            LEFT JOIN q_terms q ON q.query_id = x.query_id AND q.term = t.term GROUP BY x.query_id, x.page_id""",
        nm: f"""SELECT x.query_id, x.page_id, {tie} AS tie, ps.url, ps.pagerank, ps.rel, coalesce(a.hits, 0) AS hits, coalesce(a.dot, 0.0) AS dot
            FROM {p}_cand x JOIN {p}_ps ps ON ps.page_id = x.page_id LEFT JOIN (SELECT query_id, page_id, CAST(sum(tf_body) AS BIGINT) AS hits,
              sum({qw} * ({s} + coalesce({b}, 0.0))) AS dot FROM {p}_m GROUP BY query_id, page_id) a
              ON a.query_id = x.query_id AND a.page_id = x.page_id""",
        f"{nm}_cos": f"""SELECT x.*, CASE WHEN n.n1 * l.L1 > 0 THEN x.dot / (n.n1 * l.L1) ELSE 0.0 END AS cosine
            FROM {nm} x LEFT JOIN {nm}_L1 l USING (query_id, page_id) LEFT JOIN (SELECT query_id, sum(abs({qw})) AS n1 FROM q_idf GROUP BY query_id) n USING (query_id)""",
    }


def avg_cte(p: str) -> dict[str, str]:
    return {f"{p}_avg": f"""SELECT
        sum(ps.len_url) / count(*) AS avg_url, sum(ps.len_title) / count(*) AS avg_title,
        sum(ps.len_header) / sum(ps.n_header_d) AS avg_header, sum(ps.body_len_raw) / count(*) AS avg_body,
        sum(ps.len_anchor) / sum(ps.n_anchor_d) AS avg_anchor
        FROM {p}_pairs x JOIN {p}_ps ps USING (page_id)"""}


def bm25f_expr(prm: BM25FParams) -> tuple[str, str]:
    """(term weight w, static-rank expression) for one parameter setting."""
    raw = ("tf_url", "rtf_title", "rtf_header", "tf_body", "rtf_anchor")
    ln_ = ("len_url", "len_title", "len_header", "L", "len_anchor")
    av = ("avg_url", "avg_title", "avg_header", "avg_body", "avg_anchor")
    parts = []
    for i in range(5):
        bp = f"(1 + {prm.B[i]} * ({ln_[i]} / nullif({av[i]}, 0) - 1))"
        parts.append(f"{prm.W[i]} * (CASE WHEN {av[i]} = 0 OR {bp} = 0 THEN 0.0 ELSE {raw[i]} / {bp} END)")
    w = " + ".join(parts)
    l1, l2, pr = float(prm.lamd_prime), float(prm.lamd_prime2), "CAST(pagerank AS DOUBLE)"
    vf = {
        "logarithmic": f"(CASE WHEN {l1} + {pr} > 0 THEN ln({l1} + {pr}) ELSE 0.0 END)",
        "saturation": f"(CASE WHEN {l1} + {pr} > 0 THEN {pr} / ({l1} + {pr}) ELSE 0.0 END)",
        "sigmoid": f"(CASE WHEN {l1} + exp(-{pr} * {l2}) > 0 THEN 1.0 / ({l1} + exp(-{pr} * {l2})) ELSE 0.0 END)",
    }[prm.vf]
    return w, f"{float(prm.lamd)} * {vf}"


def bm25f_cte(p: str, prm: BM25FParams = BM25FParams(), name: str | None = None) -> dict[str, str]:
    w, static = bm25f_expr(prm)
    nm = name or f"{p}_bm25f"
    k1 = float(prm.K1)
    return {nm: f"""SELECT x.query_id, x.page_id, x.tie, x.url, x.rel, x.pagerank,
            coalesce(t.text_score, 0.0) + {static} AS bm25f, coalesce(t.text_score, 0.0) AS text_score
        FROM {p}_pairs x LEFT JOIN (
            SELECT query_id, page_id, sum(n * CASE WHEN {k1} + w <> 0 THEN w * idf / ({k1} + w) ELSE 0.0 END) AS text_score
            FROM (SELECT m.*, {w} AS w FROM {p}_m m CROSS JOIN {p}_avg) GROUP BY query_id, page_id
        ) t USING (query_id, page_id)"""}


def window_ctes(p: str) -> dict[str, str]:
    """Smallest window: for each event and each query term, the last position of the term at
    or before the event; events where all terms are seen give ``pos - min(last) + 1``.
    Fields that miss a query term are removed first (relational division)."""
    return {
        f"{p}_qd": "SELECT DISTINCT query_id, term FROM q_tok",
        f"{p}_e": f"""SELECT q.query_id, t.page_id, t.fld, t.term, t.pos FROM {p}_cand x JOIN {p}_qd q USING (query_id)
            JOIN {p}_tok t ON t.page_id = x.page_id AND t.term = q.term""",
        f"{p}_ek": f"""SELECT query_id, page_id, fld FROM (
              SELECT query_id, page_id, fld, count(DISTINCT term) AS c FROM {p}_e GROUP BY query_id, page_id, fld)
            JOIN q_stats USING (query_id) WHERE c = k""",
        f"{p}_fields": f"""SELECT e.* FROM {p}_e e SEMI JOIN {p}_ek USING (query_id, page_id, fld)""",
        f"{p}_g": f"""SELECT a.query_id, a.page_id, a.fld, a.pos, t.term, max(b.pos) AS lastpos
            FROM {p}_fields a JOIN {p}_qd t ON t.query_id = a.query_id
            JOIN {p}_fields b ON b.query_id = a.query_id AND b.page_id = a.page_id AND b.fld = a.fld
                          AND b.term = t.term AND b.pos <= a.pos
            GROUP BY a.query_id, a.page_id, a.fld, a.pos, t.term""",
        f"{p}_fw": f"""SELECT query_id, page_id, fld, CAST(min(win) AS INTEGER) AS window_size FROM (
              SELECT query_id, page_id, fld, pos, pos - min(lastpos) + 1 AS win, count(*) AS nt
              FROM {p}_g GROUP BY query_id, page_id, fld, pos) JOIN q_stats USING (query_id)
            WHERE nt = k GROUP BY query_id, page_id, fld""",
        f"{p}_win": f"""SELECT query_id, page_id, min(window_size) AS window_size FROM {p}_fw GROUP BY query_id, page_id""",
    }


def boost_sql(boost: float, fn: str, qlen: str = "qlen", window: str = "window_size") -> str:
    inv = f"greatest(1.0, {boost} * (CAST({qlen} AS DOUBLE) / {window}))"
    sig = f"greatest(1.0, {boost} * (1 - 1 / (1 + exp(-CAST({window} - {qlen} AS DOUBLE)))))"
    scaled = {"inverse": inv, "sigmoid": sig}.get(fn, "1.0")
    return (f"(CASE WHEN {window} IS NULL THEN 1.0 WHEN {window} = {qlen} THEN {float(boost)} "
            f"WHEN {window} > {qlen} THEN {scaled} ELSE 1.0 END)")


def cosine_window_cte(p: str, b: WindowBoost = WindowBoost()) -> dict[str, str]:
    return {f"{p}_cw": f"""SELECT x.*, s.qlen, w.window_size, {boost_sql(b.boost, b.function, 's.qlen', 'w.window_size')} AS boost,
            {boost_sql(b.boost, b.function, 's.qlen', 'w.window_size')} * x.cosine AS cw
        FROM {p}_pairs_cos x JOIN q_stats s USING (query_id) LEFT JOIN {p}_win w USING (query_id, page_id)"""}


# ---------------------------------------------------------------------------- assembly
def ctes_for(*wanted: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    pool = dict(BASE)
    for p in ("pg", "dc", "fr"):
        pool.update(_collection(p))
        pool.update(pairs_cte(p))
        pool.update(avg_cte(p))
        pool.update(bm25f_cte(p))
        pool.update(window_ctes(p))
        pool.update(cosine_window_cte(p))
    pool.update(extra or {})
    return pool


def with_sql(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every CTE it (transitively) needs, in dependency order."""
    import re

    pool = ctes_for(extra=extra)
    names = sorted(pool, key=len, reverse=True)
    pat = re.compile(r"\b(" + "|".join(map(re.escape, names)) + r")\b")
    order: list[str] = []

    def visit(n: str, seen: tuple = ()):
        if n in order:
            return
        for d in pat.findall(pool[n]):
            if d != n and d not in seen:
                visit(d, seen + (n,))
        if n not in order:
            order.append(n)

    for d in pat.findall(body):
        visit(d)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({pool[n]})" for n in order) + "\n" + body


def ranked_sql(src: str, score: str, extra_cols: str = "") -> str:
    return f"""SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round({score}, 9) DESC, tie) AS INTEGER) AS rank,
        page_id, url, round({score}, 6) AS score{extra_cols} FROM {src}"""
