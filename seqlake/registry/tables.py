"""Tables that the queries derive from the given ones, in Spark and as SQL.

Each entry is one statement that both engines run, or a pair where they differ
(Spark first). :func:`frame` gives a table as a DataFrame, :func:`sql` prefixes
a DuckDB statement with the tables it names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import scratch, store

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SNP = "CASE WHEN pos % 97 = 0 THEN translate(base,'ACGT','CGTA') ELSE base END"
WINDOW = "seq||" + "||".join(f"coalesce(lead(seq,{i}) OVER (PARTITION BY contig ORDER BY nth),'')" for i in range(1, 6))
PLACED = "SELECT o_orderkey AS o, contig, (o_orderkey*7919) % (len-150) AS st, seq FROM orders JOIN sample_contigs ON contig='chr'||CAST(o_custkey % 25 AS STRING)"

TABLES: dict[str, str | tuple[str, str]] = {
    "contig_tiles": """SELECT 'chr' || CAST(p_partkey % 25 AS STRING) AS contig, CAST(floor(p_partkey/25) AS BIGINT) AS tile,
        CAST(floor(p_partkey/25)*32 AS BIGINT) AS start0,
        translate(md5(CAST(p_partkey AS STRING)),'0123456789abcdef','ACGTACGTACGTACGT') AS seq FROM part""",
    "contigs": (
        "SELECT contig, listagg(seq,'') WITHIN GROUP (ORDER BY tile) AS seq, CAST(sum(length(seq)) AS BIGINT) AS len FROM contig_tiles GROUP BY contig",
        "SELECT contig, string_agg(seq,'' ORDER BY tile) AS seq, CAST(sum(length(seq)) AS BIGINT) AS len FROM contig_tiles GROUP BY contig",
    ),
    "contig_lens": "SELECT contig, CAST(sum(length(seq)) AS BIGINT) AS len FROM contig_tiles GROUP BY contig",
    "ref_bases": (
        "SELECT contig, start0+i AS pos, substr(seq,i,1) AS base FROM contig_tiles LATERAL VIEW explode(sequence(1,32)) t AS i",
        "SELECT contig, start0+i AS pos, substr(seq,CAST(i AS BIGINT),1) AS base FROM contig_tiles, (SELECT unnest(range(1,33)) AS i)",
    ),
    "known_sites": "SELECT contig, pos FROM ref_bases WHERE pos % 97 = 0",
    "sample_contigs": (
        f"SELECT contig, listagg({SNP},'') WITHIN GROUP (ORDER BY pos) AS seq, count(*) AS len FROM ref_bases GROUP BY contig",
        f"SELECT contig, string_agg({SNP},'' ORDER BY pos) AS seq, count(*) AS len FROM ref_bases GROUP BY contig",
    ),
    # tiles of the sample and, from each of them on, the bases that a pair of reads lies on: Spark cuts reads out of these, SQL out of whole contigs
    "sample_tiles": ("""SELECT contig, row_number() OVER (PARTITION BY contig ORDER BY tile) - 1 AS nth,
        CASE WHEN at > 0 THEN overlay(seq PLACING translate(substr(seq,at,1),'ACGT','CGTA') FROM at) ELSE seq END AS seq
      FROM (SELECT *, CAST(32 - (start0+32) % 97 AS INT) AS at FROM contig_tiles)""", ""),
    "sample_windows": (f"SELECT contig, nth, {WINDOW} AS bases FROM sample_tiles", ""),
    "placed_pairs": ("""SELECT o, p.contig, st, coalesce(substr(bases,CAST(st % 32 + 1 AS INT),140),'') AS bases
      FROM (SELECT o_orderkey AS o, contig, (o_orderkey*7919) % (len-150) AS st FROM orders JOIN contig_lens ON contig='chr'||CAST(o_custkey % 25 AS STRING)) p
      LEFT JOIN sample_windows w ON w.contig = p.contig AND w.nth = st div 32""", ""),
    "placed_reads": tuple(f"""SELECT name, o, mate,
        CASE WHEN o % 11 = 0 AND mate = 1 THEN substr(s,1,20) || translate(substr(s,21,1),'ACGT','TGCA') || substr(s,22) ELSE s END AS seq,
        substr(translate(md5(name||'a'||CAST(mate AS STRING))||md5(name||'b'||CAST(mate AS STRING)),'0123456789abcdef','56789:;<=>?@ABCD'),1,40) AS qual,
        contig AS true_contig, st+1 AS true_pos
      FROM ({pairs}) r""" for pairs in (
        """SELECT o, 'r'||lpad(CAST(o AS STRING),7,'0') AS name, m.mate, contig, st + (m.mate-1)*100 AS st,
          CASE m.mate WHEN 1 THEN substr(bases,1,40) ELSE reverse(translate(substr(bases,101,40),'ACGT','TGCA')) END AS s FROM placed_pairs CROSS JOIN (VALUES (1),(2)) m(mate)""",
        f"""
        SELECT o, 'r'||lpad(CAST(o AS STRING),7,'0') AS name, 1 AS mate, contig, st, substr(seq,CAST(st+1 AS INT),40) AS s FROM ({PLACED}) a
        UNION ALL
        SELECT o, 'r'||lpad(CAST(o AS STRING),7,'0') AS name, 2 AS mate, contig, st+100 AS st, reverse(translate(substr(seq,CAST(st+101 AS INT),40),'ACGT','TGCA')) AS s FROM ({PLACED}) b""",
    )),
    "reads": "SELECT name, mate, seq, qual FROM placed_reads",
    # the same reads with up to four bases changed, at places that depend on the read
    "worn_reads": """SELECT name, mate, qual, substr(a,1,p3-1)||translate(substr(a,p3,1),'ACGT','CGTA')||substr(a,p3+1) AS seq FROM (
        SELECT name, mate, qual, CAST((o*7 + mate) % 40 + 1 AS INT) AS p3, substr(b,1,p2-1)||translate(substr(b,p2,1),'ACGT','GTAC')||substr(b,p2+1) AS a, o FROM (
          SELECT name, mate, qual, CAST((o*3 + mate) % 40 + 1 AS INT) AS p2, substr(seq,1,p1-1)||translate(substr(seq,p1,2),'ACGT','TACG')||substr(seq,p1+2) AS b, o FROM (
            SELECT name, mate, qual, CAST(o % 39 + 1 AS INT) AS p1, seq, o FROM placed_reads) x) y) z""",
    "vcf_shards": (
        # a call meets its tile: no row for every base of the genome
        """SELECT CAST(o_orderkey % 8 AS INT) AS shard, contig, pos, ref, translate(ref,'ACGT','CGTA') AS alt, qual,
        CASE WHEN (qual + o_orderkey % 8) % 3 = 0 THEN '0/1' ELSE '1/1' END AS gt
      FROM (SELECT q.*, substr(t.seq,CAST((q.pos-1) % 32 + 1 AS INT),1) AS ref
        FROM (SELECT o_orderkey, 'chr'||CAST(o_custkey % 25 AS STRING) AS contig, 1+(o_orderkey*7919) % 200 AS pos,
                     CAST(floor(o_totalprice/1000) AS BIGINT) AS qual FROM orders) q
        JOIN contig_tiles t ON t.contig=q.contig AND t.tile = (q.pos-1) div 32) c""",
        """SELECT CAST(o_orderkey % 8 AS INT) AS shard, q.contig, q.pos, r.base AS ref, translate(r.base,'ACGT','CGTA') AS alt, q.qual,
        CASE WHEN (q.qual + q.o_orderkey % 8) % 3 = 0 THEN '0/1' ELSE '1/1' END AS gt
      FROM (SELECT o_orderkey, 'chr'||CAST(o_custkey % 25 AS STRING) AS contig, 1+(o_orderkey*7919) % 200 AS pos,
                   CAST(floor(o_totalprice/1000) AS BIGINT) AS qual FROM orders) q
      JOIN ref_bases r ON r.contig=q.contig AND r.pos=q.pos""",
    ),
    "exons": """SELECT substr(o_orderpriority,1,1) AS sample, 'T'||CAST(o_orderkey AS STRING) AS transcript_id, 'G'||CAST(o_custkey AS STRING) AS gene_id,
        'chr'||CAST(o_custkey % 25 AS STRING) AS contig, CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_linenumber AS exon_number,
        CAST(floor(o_custkey/25)*10000 + l_linenumber*1000 + min(l_partkey) % 3 * 50 AS BIGINT) AS start,
        CAST(floor(o_custkey/25)*10000 + l_linenumber*1000 + min(l_partkey) % 3 * 50 + 200 + (min(l_suppkey) % 2) * 100 AS BIGINT) AS "end"
      FROM orders JOIN lineitem ON l_orderkey=o_orderkey GROUP BY o_orderkey, o_custkey, o_orderpriority, l_linenumber""",
    "ref_exons": "SELECT * FROM exons WHERE CAST(substr(transcript_id,2) AS BIGINT) % 10 = 0",
    "query_exons": "SELECT * FROM exons WHERE CAST(substr(transcript_id,2) AS BIGINT) % 10 <> 0",
    "rna_hits": """SELECT sample, 'h'||transcript_id||'.'||CAST(exon_number AS STRING) AS name, contig, strand,
        start + exon_number*7 AS start, start + exon_number*7 + 74 AS "end" FROM exons""",
    "feature_bed": """SELECT 'chr'||CAST(p_partkey % 25 AS STRING) AS contig, CAST(p_partkey*300 AS BIGINT) AS start0,
        CAST(p_partkey*300+150+p_size AS BIGINT) AS end0, p_brand AS name, 'kb|g.'||CAST(p_partkey AS STRING) AS fid FROM part""",
    "gene_abundance": """SELECT 'G'||CAST(o_custkey AS STRING) AS gene_id, CASE WHEN o_orderkey % 2 = 0 THEN 'T1' ELSE 'T2' END AS condition,
        CAST(o_orderkey AS STRING) AS replicate, CAST(round(o_totalprice) AS BIGINT) AS amount FROM orders""",
    "genome_files": """SELECT CASE p_partkey % 4 WHEN 0 THEN 'kb_g.'||CAST(p_partkey AS STRING)||'_samtools.tar.gz'
        WHEN 1 THEN 'org'||CAST(p_partkey AS STRING)||'_samtools.tar.gz' WHEN 2 THEN 'org'||CAST(p_partkey AS STRING)||'_bowtie.tar.gz'
        ELSE 'samtools.tar.gz' END AS name, CAST(p_size AS BIGINT) AS length FROM part""",
    "job_events": """SELECT event_id, 'job_'||CAST(user_id AS STRING)||'_'||CAST(event_id % 4 AS STRING) AS job_id, 'u'||CAST(user_id % 10 AS STRING) AS username,
        CAST(CASE event_type WHEN 'signup' THEN 4 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 ELSE 1 END AS INT) AS running_state,
        (event_id % 101)/100.0E0 AS map_progress, ts FROM events""",
    "id_keys": "SELECT c_name || '::kb|g.' || CAST(c_nationkey AS STRING) AS key, c_custkey FROM customer",
    "id_registry": "SELECT key, 'kb|sample.' || CAST(c_custkey AS STRING) AS id FROM id_keys WHERE c_custkey % 3 <> 0",
    "spliced_reads": """SELECT 'j'||a.contig||'.'||CAST(a.tile AS STRING) AS name, substr(a.seq,13,20)||substr(b.seq,1,20) AS seq
      FROM contig_tiles a JOIN contig_tiles b ON a.contig = b.contig AND b.tile = a.tile + 4 WHERE a.tile % 3 = 0""",
    "source_lines": "SELECT c_nationkey % 4 AS src, c_name AS value FROM customer",
    # the remaining tables exist as SQL only: what Spark's operators compute
    "ranks": ("", "SELECT contig, len, CAST(row_number() OVER (ORDER BY CAST(regexp_extract(contig,'([0-9]+)',1) AS BIGINT), contig) AS INT) AS rank FROM contig_lens"),
    "kmers": ("", """SELECT * FROM (SELECT substr(seq, CAST(i AS BIGINT), 16) AS kmer, contig, i - 1 AS pos0, count(*) OVER (PARTITION BY substr(seq, CAST(i AS BIGINT), 16)) AS occ
        FROM (SELECT contig, seq, unnest(range(1, len-14)) AS i FROM contigs)) WHERE occ <= 200"""),
    "seeds": ("", """SELECT name, mate, rev, s, q, o, substr(s, o+1, 16) AS kmer FROM (
        SELECT name, mate, false AS rev, seq AS s, qual AS q FROM reads UNION ALL
        SELECT name, mate, true, reverse(translate(seq,'ACGT','TGCA')), reverse(qual) FROM reads), (VALUES (0),(12),(24)) v(o)"""),
    "places": ("", """SELECT * FROM (SELECT d.name, d.mate, d.rev, d.contig, st+1 AS pos, s AS seq, q AS qual,
          CAST(len(list_filter(range(1, length(s)+1), lambda i: substr(s, i, 1) <> substr(c.seq, st+i, 1))) AS INT) AS nm
        FROM (SELECT DISTINCT name, mate, rev, s, q, contig, pos0 - o AS st FROM seeds JOIN kmers USING (kmer)) d
        JOIN contigs c USING (contig) WHERE st >= 0 AND st + length(s) <= c.len) WHERE nm <= 4"""),
    "aligned": ("", """SELECT name, mate, rev, contig, pos, seq, qual, nm, CAST(CASE WHEN ties = 1 THEN 60 ELSE 0 END AS INT) AS mapq FROM (
        SELECT *, row_number() OVER (PARTITION BY name, mate ORDER BY nm, contig, pos, rev) AS first, count(*) OVER (PARTITION BY name, mate, nm) AS ties FROM places) WHERE first = 1"""),
    # places of at most four mismatches anywhere: one of five disjoint parts is exact
    "short_kmers": ("", "SELECT substr(seq, CAST(i AS BIGINT), 8) AS kmer, contig, i - 1 AS pos0 FROM (SELECT contig, seq, unnest(range(1, len-6)) AS i FROM contigs)"),
    "every_place": ("", """SELECT * FROM (SELECT d.name, d.mate, d.rev, d.contig, st+1 AS pos,
          CAST(len(list_filter(range(1, length(s)+1), lambda i: substr(s, i, 1) <> substr(c.seq, st+i, 1))) AS INT) AS nm
        FROM (SELECT DISTINCT name, mate, rev, s, contig, pos0 - o AS st FROM (SELECT name, mate, rev, s, o, substr(s, o+1, 8) AS kmer FROM (
            SELECT name, mate, false AS rev, seq AS s FROM worn_reads UNION ALL SELECT name, mate, true, reverse(translate(seq,'ACGT','TGCA')) FROM worn_reads), (VALUES (0),(8),(16),(24),(32)) v(o))
          JOIN short_kmers USING (kmer)) d JOIN contigs c USING (contig) WHERE st >= 0 AND st + length(s) <= c.len) WHERE nm <= 4"""),
    "every_best": ("", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, mate ORDER BY nm, contig, pos, rev) AS first, count(*) OVER (PARTITION BY name, mate, nm) AS ties
        FROM every_place) WHERE first = 1"""),
    "bases": ("", """SELECT contig, pos + i - 1 AS pos, substr(seq, i, 1) AS base FROM (SELECT *, unnest(range(1, length(seq)+1)) AS i FROM aligned WHERE mapq > 0)
        WHERE ascii(substr(qual, i, 1)) - 33 >= 25"""),
    "piles": ("", "SELECT contig, pos, base, count(*) AS n FROM bases GROUP BY ALL"),
    "calls": ("", """SELECT * FROM (SELECT p.contig, p.pos, r.base AS ref, p.base AS alt, p.n*10 AS qual, depth, p.n AS alt_n,
          CASE WHEN p.n*5 >= depth*4 THEN '1/1' WHEN p.n*5 >= depth THEN '0/1' END AS gt
        FROM piles p JOIN (SELECT contig, pos, CAST(sum(n) AS BIGINT) AS depth FROM piles GROUP BY ALL) d USING (contig, pos) JOIN ref_bases r USING (contig, pos)
        WHERE depth >= 4 AND p.base <> r.base) WHERE gt IS NOT NULL"""),
    "read_bases": ("", """SELECT name, mate, contig, rev, cycle, CASE WHEN rev THEN pos + length(seq) - cycle ELSE pos + cycle - 1 END AS pos,
          CASE WHEN rev THEN length(seq) - cycle ELSE cycle - 1 END AS place, ascii(substr(rq, cycle, 1)) - 33 AS reported_q, substr('N'||read, cycle, 2) AS context, mapq
        FROM (SELECT *, CASE WHEN rev THEN reverse(translate(seq,'ACGT','TGCA')) ELSE seq END AS read, CASE WHEN rev THEN reverse(qual) ELSE qual END AS rq,
          CAST(unnest(range(1, length(seq)+1)) AS INT) AS cycle FROM aligned)"""),
    "covariates": ("", """SELECT reported_q, cycle, context, count(*) AS n_obs,
          count(*) FILTER (WHERE substr(context, 2, 1) <> CASE WHEN rev THEN translate(r.base,'ACGT','TGCA') ELSE r.base END) AS n_mismatch
        FROM read_bases b JOIN ref_bases r USING (contig, pos) WHERE mapq > 0 AND NOT EXISTS (SELECT 1 FROM known_sites k WHERE k.contig = b.contig AND k.pos = b.pos) GROUP BY ALL"""),
    "called_covariates": ("", """SELECT reported_q, cycle, context, count(*) AS n_obs,
          count(*) FILTER (WHERE substr(context, 2, 1) <> CASE WHEN rev THEN translate(r.base,'ACGT','TGCA') ELSE r.base END) AS n_mismatch
        FROM read_bases b JOIN ref_bases r USING (contig, pos) WHERE mapq > 0 AND NOT EXISTS (SELECT 1 FROM calls k WHERE k.contig = b.contig AND k.pos = b.pos) GROUP BY ALL"""),
    "recalled_piles": ("", """SELECT contig, pos, CASE WHEN rev THEN translate(substr(context, 2, 1),'ACGT','TGCA') ELSE substr(context, 2, 1) END AS base, count(*) AS n
        FROM read_bases LEFT JOIN called_covariates USING (reported_q, cycle, context)
        WHERE mapq > 0 AND coalesce(CAST(least(40, greatest(1, round(-10*log10((n_mismatch+1)/(n_obs+2))))) AS INT), reported_q) >= 25 GROUP BY ALL"""),
    "recalled": ("", """SELECT * FROM (SELECT p.contig, p.pos, r.base AS ref, p.base AS alt, p.n*10 AS qual,
          CASE WHEN p.n*5 >= depth*4 THEN '1/1' WHEN p.n*5 >= depth THEN '0/1' END AS gt
        FROM recalled_piles p JOIN (SELECT contig, pos, CAST(sum(n) AS BIGINT) AS depth FROM recalled_piles GROUP BY ALL) d USING (contig, pos) JOIN ref_bases r USING (contig, pos)
        WHERE depth >= 4 AND p.base <> r.base) WHERE gt IS NOT NULL"""),
    "merged_vcf": ("", """SELECT coalesce(k.rank, 2147483647) AS rank, contig, pos, ref, alt, qual, shard, gt FROM (
        SELECT *, row_number() OVER (PARTITION BY contig, pos, ref, alt ORDER BY qual DESC, shard) AS first FROM vcf_shards) LEFT JOIN ranks k USING (contig) WHERE first = 1"""),
    "chains": ("", """SELECT transcript_id, contig, strand, count(*) AS n_exons, string_agg(CAST("end" AS STRING)||'-'||CAST(nx AS STRING), ',' ORDER BY start, "end") AS chain
        FROM (SELECT *, lead(start) OVER (PARTITION BY transcript_id ORDER BY start, "end") AS nx FROM exons) GROUP BY ALL"""),
    "abundance": ("", """SELECT e.sample, e.transcript_id, e.length, coalesce(n_frag, 0) AS n_frag,
          CAST((CAST(coalesce(n_frag, 0) AS HUGEINT) * 1000000000000) // (CAST(e.length AS HUGEINT) * total) AS BIGINT) AS milli_fpkm
        FROM (SELECT sample, transcript_id, CAST(sum("end" - start + 1) AS BIGINT) AS length FROM exons GROUP BY ALL) e
        LEFT JOIN (SELECT x.sample, x.transcript_id, count(DISTINCT h.name) AS n_frag FROM exons x JOIN rna_hits h
          ON h.sample = x.sample AND h.contig = x.contig AND h.strand = x.strand AND h.start <= x."end" AND h."end" >= x.start GROUP BY ALL) f USING (sample, transcript_id)
        JOIN (SELECT sample, count(DISTINCT name) AS total FROM rna_hits GROUP BY ALL) t USING (sample)"""),
    "latest": ("", """SELECT job_id, username, running_state, CAST(trunc(map_progress*100) AS INT) AS progress, running_state = 2 AS complete, event_id
        FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, event_id DESC) AS first FROM job_events) WHERE first = 1"""),
    "overlapping": ("", """SELECT a.contig, a.start0, a.end0, a.name, a.fid, b.sample, b.transcript_id, b.gene_id, b.strand, b.exon_number, b.start, b."end",
          least(a.end0, b."end") - greatest(a.start0, b.start-1) AS overlap
        FROM feature_bed a JOIN exons b ON a.contig = b.contig AND a.start0 < b."end" AND a.end0 > b.start-1
        WHERE least(a.end0, b."end") - greatest(a.start0, b.start-1) >= 1 AND (least(a.end0, b."end") - greatest(a.start0, b.start-1))*100 >= (a.end0-a.start0)*90"""),
    "deduped": ("", """SELECT transcript_id, contig, fid, start, "end", strand, sample FROM (
        SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY CAST(regexp_extract(contig,'([0-9]+)',1) AS BIGINT), start, "end", fid, strand) AS first FROM overlapping) WHERE first = 1"""),
    "tests": ("", """SELECT gene_id, n0, n1, log2fc, round(t, 6) AS stat,
          round(CASE WHEN t IS NOT NULL THEN ((((((1.061405429E0*k) + -1.453152027E0)*k + 1.421413741E0)*k + -0.284496736E0)*k + 0.254829592E0)*k)*exp(-(z*z))
            WHEN v = 0 THEN CASE WHEN m0 = m1 THEN 1.0E0 ELSE 0.0E0 END END, 6) AS p
        FROM (SELECT *, abs(t)/1.4142135623730951E0 AS z, 1.0E0/(1.0E0 + 0.3275911E0*(abs(t)/1.4142135623730951E0)) AS k FROM (
          SELECT *, CASE WHEN v > 0 THEN (m1-m0)/sqrt(v) END AS t FROM (
            SELECT *, round(log2((m1+1.0E0)/(m0+1.0E0)), 4) AS log2fc, CASE WHEN n0 >= 2 AND n1 >= 2 THEN
              CAST(n0*ss0 - s0*s0 AS DOUBLE)/CAST(n0*n0*(n0-1) AS DOUBLE) + CAST(n1*ss1 - s1*s1 AS DOUBLE)/CAST(n1*n1*(n1-1) AS DOUBLE) END AS v FROM (
              SELECT *, CASE WHEN n0 > 0 THEN CAST(s0 AS DOUBLE)/n0 ELSE 0.0E0 END AS m0, CASE WHEN n1 > 0 THEN CAST(s1 AS DOUBLE)/n1 ELSE 0.0E0 END AS m1 FROM (
                SELECT gene_id, count(*) FILTER (WHERE condition = 'T1') AS n0, coalesce(sum(amount) FILTER (WHERE condition = 'T1'), 0) AS s0,
                  coalesce(sum(CAST(amount AS HUGEINT)*amount) FILTER (WHERE condition = 'T1'), 0) AS ss0,
                  count(*) FILTER (WHERE condition = 'T2') AS n1, coalesce(sum(amount) FILTER (WHERE condition = 'T2'), 0) AS s1,
                  coalesce(sum(CAST(amount AS HUGEINT)*amount) FILTER (WHERE condition = 'T2'), 0) AS ss1
                FROM test_amounts GROUP BY gene_id)))))"""),
    "test_amounts": ("", "SELECT gene_id, condition, amount FROM gene_abundance"),
    "qvalues": ("", """SELECT *, CASE WHEN p IS NOT NULL THEN round(least(1.0E0, min(p*m/rank) OVER (PARTITION BY p IS NULL ORDER BY p DESC, gene_id DESC ROWS UNBOUNDED PRECEDING)), 6) END AS q FROM (
        SELECT *, row_number() OVER (PARTITION BY p IS NULL ORDER BY p, gene_id) AS rank, count(p) OVER () AS m FROM tests)"""),
    "junctions": ("", """SELECT transcript_id, contig, strand, "end" AS donor, nx AS acceptor FROM (
        SELECT *, lead(start) OVER (PARTITION BY transcript_id ORDER BY start, "end") AS nx FROM exons) WHERE nx IS NOT NULL"""),
    "classes": ("", """SELECT q.transcript_id, coalesce(split_part('=,c,j,o,i,x', ',', b.code+1), 'u') AS class_code, b.ref_transcript_id
        FROM (SELECT DISTINCT transcript_id FROM query_exons) q LEFT JOIN (
          SELECT transcript_id, code, ref_transcript_id, row_number() OVER (PARTITION BY transcript_id ORDER BY code, ref_transcript_id) AS first FROM (
            SELECT j.transcript_id, CASE WHEN a.chain = r.chain THEN 0 WHEN contains(','||r.chain||',', ','||a.chain||',') THEN 1 ELSE 2 END AS code, j.ref_transcript_id
            FROM (SELECT DISTINCT x.transcript_id, y.transcript_id AS ref_transcript_id FROM junctions x JOIN junctions y USING (contig, strand, donor, acceptor)
              WHERE x.transcript_id IN (SELECT transcript_id FROM query_exons) AND y.transcript_id IN (SELECT transcript_id FROM ref_exons)) j
            JOIN chains a ON a.transcript_id = j.transcript_id JOIN chains r ON r.transcript_id = j.ref_transcript_id
            UNION ALL SELECT x.transcript_id, CASE WHEN x.strand = y.strand THEN 3 ELSE 5 END, y.transcript_id FROM query_exons x JOIN ref_exons y
              ON x.contig = y.contig AND x.start <= y."end" AND x."end" >= y.start
            UNION ALL SELECT s.transcript_id, 4, j.transcript_id FROM (SELECT transcript_id, contig, min(start) AS a, max("end") AS b FROM query_exons GROUP BY ALL) s
              JOIN junctions j ON j.contig = s.contig AND s.a > j.donor AND s.b < j.acceptor WHERE j.transcript_id IN (SELECT transcript_id FROM ref_exons))) b
        ON b.transcript_id = q.transcript_id AND b.first = 1"""),
}

# the same tests on abundances, samples 1 and 2 as conditions
TABLES["fpkm_amounts"] = ("", """SELECT gene_id, CASE sample WHEN '1' THEN 'T1' ELSE 'T2' END AS condition, milli_fpkm AS amount
    FROM abundance JOIN (SELECT DISTINCT transcript_id, gene_id FROM exons) g USING (transcript_id) WHERE sample IN ('1', '2')""")
TABLES["fpkm_tests"] = ("", TABLES["tests"][1].replace("test_amounts", "fpkm_amounts"))
TABLES["fpkm_qvalues"] = ("", TABLES["qvalues"][1].replace("FROM tests", "FROM fpkm_tests"))

# the first calls, covariates and second calls of reads with two reported qualities, of which one is too low for the first calls
TABLES["firm_aligned"] = ("", "SELECT * REPLACE (translate(qual, '56789:;<=>?@ABCD', '55555555????????') AS qual) FROM aligned")
FIRM = ("bases", "piles", "calls", "read_bases", "called_covariates", "recalled_piles", "recalled")
for _t in FIRM:
    TABLES[f"firm_{_t}"] = ("", re.sub(rf"\b(FROM|JOIN) (aligned|{'|'.join(FIRM)})\b", r"\1 firm_\2", TABLES[_t][1]))

# blocks of each sample and strand, loci of all samples, and what is said of the loci
TABLES["sample_blocks"] = ("", """SELECT sample, contig, strand, island, min(start) AS start, max("end") AS "end" FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY sample, contig, strand ORDER BY start, "end", name ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY sample, contig, strand ORDER BY start, "end", name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 50 THEN 0 ELSE 1 END AS fresh
      FROM rna_hits)) GROUP BY ALL""")
TABLES["loci"] = ("", """SELECT contig||'.'||strand||'.'||CAST(island AS STRING) AS locus, contig, strand, min(start) AS start, max("end") AS "end", count(*) AS n_transcripts FROM (
    SELECT contig, strand, sample, start, "end", sum(fresh) OVER (PARTITION BY contig, strand ORDER BY start, "end", sample ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY contig, strand ORDER BY start, "end", sample ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
      FROM sample_blocks)) GROUP BY contig, strand, island""")
TABLES["locus_amounts"] = ("", """SELECT l.locus AS gene_id, CASE WHEN t.sample IN ('1', '2') THEN 'T1' ELSE 'T2' END AS condition,
      CAST((CAST(coalesce(n_frag, 0) AS HUGEINT) * 1000000000000) // (CAST(l."end" - l.start + 1 AS HUGEINT) * total) AS BIGINT) AS amount
    FROM loci l CROSS JOIN (SELECT sample, count(DISTINCT name) AS total FROM rna_hits GROUP BY ALL) t
    LEFT JOIN (SELECT h.sample, x.locus, count(DISTINCT h.name) AS n_frag FROM loci x JOIN rna_hits h
      ON h.contig = x.contig AND h.strand = x.strand AND h.start <= x."end" AND h."end" >= x.start GROUP BY ALL) f ON f.sample = t.sample AND f.locus = l.locus""")
TABLES["locus_tests"] = ("", TABLES["tests"][1].replace("test_amounts", "locus_amounts"))
TABLES["locus_qvalues"] = ("", TABLES["qvalues"][1].replace("FROM tests", "FROM locus_tests"))
TABLES["locus_classes"] = ("", """SELECT locus, code, ref_transcript_id FROM (
    SELECT *, row_number() OVER (PARTITION BY locus ORDER BY code, ref_transcript_id) AS first FROM (
      SELECT x.locus, CASE WHEN x.strand = y.strand THEN 3 ELSE 5 END AS code, y.transcript_id AS ref_transcript_id
      FROM loci x JOIN ref_exons y ON x.contig = y.contig AND x.start <= y."end" AND x."end" >= y.start
      UNION ALL SELECT s.locus, 4, j.transcript_id FROM loci s JOIN junctions j ON j.contig = s.contig AND s.start > j.donor AND s."end" < j.acceptor
      WHERE j.transcript_id IN (SELECT transcript_id FROM ref_exons))) WHERE first = 1""")


# fragments shared out over the transcripts that they fit, in whole millionths
TABLES["em_classes"] = ("", """SELECT sample, transcripts, count(*) AS n FROM (SELECT sample, name, string_agg(transcript_id, ',' ORDER BY transcript_id) AS transcripts FROM (
    SELECT DISTINCT h.sample, h.name, x.transcript_id FROM exons x JOIN rna_hits h ON h.sample = x.sample AND h.contig = x.contig AND h.strand = x.strand AND h.start <= x."end" AND h."end" >= x.start)
    GROUP BY ALL) GROUP BY ALL""")
TABLES["em_members"] = ("", "SELECT sample, transcripts, n, unnest(string_split(transcripts, ',')) AS transcript_id FROM em_classes")
TABLES["em_0"] = ("", 'SELECT sample, transcript_id, CAST(sum("end" - start + 1) AS HUGEINT) AS length, CAST(1000000 AS HUGEINT) AS amount FROM exons GROUP BY ALL')
for _i in range(4):
    TABLES[f"em_{_i + 1}"] = ("", f"""SELECT sample, transcript_id, length, coalesce(dealt, 0) AS amount FROM em_{_i} LEFT JOIN (
        SELECT sample, transcript_id, CAST(sum(CASE WHEN total = 0 THEN n*1000000 // many ELSE CAST(n AS HUGEINT)*1000000*rate // total END) AS HUGEINT) AS dealt FROM (
          SELECT *, CAST(sum(rate) OVER (PARTITION BY sample, transcripts) AS HUGEINT) AS total, count(*) OVER (PARTITION BY sample, transcripts) AS many
          FROM em_members JOIN (SELECT sample, transcript_id, amount*1000000 // length AS rate FROM em_{_i}) USING (sample, transcript_id)) GROUP BY ALL) USING (sample, transcript_id)""")

# a study from reads to compared genes: genes of three exons, each a tile, three tiles apart
TABLES["rna_genes"] = """SELECT a.contig, a.tile, a.seq AS e1, b.seq AS e2, c.seq AS e3, CAST(substr(a.contig,4) AS BIGINT) + CAST(floor(a.tile/12) AS BIGINT) AS g
    FROM contig_tiles a JOIN contig_tiles b ON b.contig = a.contig AND b.tile = a.tile + 3 JOIN contig_tiles c ON c.contig = a.contig AND c.tile = a.tile + 6 WHERE a.tile % 12 = 0"""
TABLES["rna_reads"] = """SELECT CAST(s AS STRING) AS sample, contig||'.'||CAST(tile AS STRING)||'.'||CAST(k AS STRING)||'.'||CAST(n AS STRING) AS name,
      CASE WHEN g % 2 = 1 THEN reverse(translate(seq,'ACGT','TGCA')) ELSE seq END AS seq FROM (
    SELECT s, contig, tile, k, n, g, CASE k WHEN 0 THEN e1 WHEN 1 THEN e2 WHEN 2 THEN e3 WHEN 3 THEN substr(e1,13)||substr(e2,1,20) WHEN 4 THEN substr(e2,13)||substr(e3,1,20) ELSE substr(e1,13)||substr(e3,1,20) END AS seq
    FROM rna_genes CROSS JOIN (VALUES (1),(2),(3),(4)) samples(s) CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5)) kinds(k) CROSS JOIN (VALUES (1),(2),(3),(4),(5)) copies(n)
    WHERE n <= 1 + (g*7 + s*3 + k) % 4 + CASE WHEN s > 2 AND g % 3 = 0 THEN 1 ELSE 0 END AND (k <> 5 OR (g + s) % 3 = 0) AND (k NOT IN (2, 4) OR g % 5 <> 2) AND (k <> 3 OR g % 7 <> 3)) r"""
TABLES["rna_ref_exons"] = """SELECT 'R'||contig||'.'||CAST(tile AS STRING) AS transcript_id, contig, CASE WHEN g % 4 = 2 OR g % 2 = 1 THEN '-' ELSE '+' END AS strand, n AS exon_number,
      (tile + 3*(n-1))*32 + 1 AS start, (tile + 3*(n-1))*32 + 32 AS "end" FROM rna_genes CROSS JOIN (VALUES (1),(2),(3)) parts(n) WHERE g % 4 <> 1"""
TABLES["rna_keyed"] = ("", "SELECT sample||' '||name AS name, 0 AS mate, seq, '' AS qual FROM rna_reads")
for _t in ("seeds", "places", "aligned"):
    TABLES[f"rna_{_t}"] = ("", re.sub(r"\b(FROM|JOIN) (seeds|places)\b", r"\1 rna_\2", TABLES[_t][1]).replace("FROM reads", "FROM rna_keyed"))
TABLES["rna_unplaced"] = ("", "SELECT name, seq FROM rna_keyed WHERE name NOT IN (SELECT name FROM rna_aligned)")
TABLES["rna_splits"] = ("", """SELECT *, row_number() OVER (PARTITION BY name ORDER BY nm, contig, l, l + s, r + 16 - n + s + 1, r, strand) AS best FROM (
    SELECT *, row_number() OVER (PARTITION BY name, strand, contig, l, r ORDER BY nm, s) AS first FROM (
      SELECT x.*, CAST(len(list_filter(range(1, n+1), lambda i: substr(x.s1, i, 1) <> CASE WHEN i <= s THEN substr(c.seq, l+i, 1) ELSE substr(c.seq, r+16-n+i, 1) END)) AS INT) AS nm
      FROM (SELECT q.*, a.contig, a.pos0 AS l, b.pos0 AS r, length(q.s1) AS n, unnest(range(16, length(q.s1)-15)) AS s FROM (
          SELECT name, seq AS s1, '+' AS strand FROM rna_unplaced UNION ALL SELECT name, reverse(translate(seq,'ACGT','TGCA')), '-' FROM rna_unplaced) q
        JOIN kmers a ON a.kmer = substr(q.s1, 1, 16) JOIN kmers b ON b.kmer = substr(q.s1, length(q.s1)-15, 16) AND b.contig = a.contig
        WHERE b.pos0 - a.pos0 - (length(q.s1) - 16) BETWEEN 20 AND 20000) x JOIN contigs c USING (contig))) WHERE first = 1 AND nm <= 4""")
TABLES["rna_blocks"] = ("", """SELECT split_part(name, ' ', 1) AS sample, name, contig, CASE WHEN rev THEN '-' ELSE '+' END AS strand, pos AS start, pos + length(seq) - 1 AS "end" FROM rna_aligned WHERE mapq > 0
    UNION ALL SELECT split_part(name, ' ', 1), name, contig, strand, l + 1, l + s FROM rna_splits WHERE best = 1
    UNION ALL SELECT split_part(name, ' ', 1), name, contig, strand, r + 16 - n + s + 1, r + 16 FROM rna_splits WHERE best = 1""")
TABLES["rna_junctions"] = ("", """SELECT split_part(name, ' ', 1) AS sample, contig, strand, l + s AS donor, r + 16 - n + s + 1 AS acceptor, count(*) AS support
    FROM rna_splits WHERE best = 1 GROUP BY ALL HAVING count(*) >= 2""")
TABLES["rna_cover"] = ("", """SELECT sample, contig, strand, pos, count(*) AS depth FROM (SELECT sample, contig, strand, unnest(range(start, "end"+1)) AS pos FROM rna_blocks) GROUP BY ALL""")
TABLES["rna_cuts"] = ("", "SELECT sample, contig, strand, donor + 1 AS pos, 1 AS cut FROM rna_junctions UNION SELECT sample, contig, strand, acceptor, 1 FROM rna_junctions")
TABLES["rna_nodes"] = ("", """SELECT sample, contig, strand, min(pos) AS start, max(pos) AS "end", CAST(sum(depth) AS BIGINT) AS weight FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY sample, contig, strand ORDER BY pos ROWS UNBOUNDED PRECEDING) AS seg FROM (
      SELECT *, CASE WHEN cut IS NULL AND lag(pos) OVER (PARTITION BY sample, contig, strand ORDER BY pos) = pos - 1 THEN 0 ELSE 1 END AS fresh
      FROM rna_cover LEFT JOIN rna_cuts USING (sample, contig, strand, pos))) GROUP BY sample, contig, strand, seg""")
TABLES["rna_edges"] = ("", """SELECT sample, contig, strand, a.start AS u, b.start AS v, CAST(0 AS BIGINT) AS support FROM rna_nodes a JOIN rna_nodes b USING (sample, contig, strand) WHERE b.start = a."end" + 1
    UNION ALL SELECT sample, contig, strand, a.start, b.start, support FROM rna_junctions j JOIN rna_nodes a USING (sample, contig, strand) JOIN rna_nodes b USING (sample, contig, strand)
    WHERE a."end" = j.donor AND b.start = j.acceptor""")
# all ways to a node, written backwards, and all ways from it
TABLES["rna_back"] = ("", """SELECT sample, contig, strand, start AS v, weight AS w, [start] AS path FROM rna_nodes
    UNION ALL SELECT p.sample, p.contig, p.strand, e.v, p.w + e.support + n.weight, list_prepend(e.v, p.path) FROM rna_back p JOIN rna_edges e ON e.sample = p.sample AND e.contig = p.contig AND e.strand = p.strand AND e.u = p.v
      JOIN rna_nodes n ON n.sample = p.sample AND n.contig = p.contig AND n.strand = p.strand AND n.start = e.v""")
TABLES["rna_forth"] = ("", """SELECT sample, contig, strand, start AS v, weight AS w, [start] AS path FROM rna_nodes
    UNION ALL SELECT p.sample, p.contig, p.strand, e.u, p.w + e.support + n.weight, list_prepend(e.u, p.path) FROM rna_forth p JOIN rna_edges e ON e.sample = p.sample AND e.contig = p.contig AND e.strand = p.strand AND e.v = p.v
      JOIN rna_nodes n ON n.sample = p.sample AND n.contig = p.contig AND n.strand = p.strand AND n.start = e.u""")
for _t in ("back", "forth"):
    TABLES[f"rna_best_{_t}"] = ("", f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample, contig, strand, v ORDER BY w DESC, path) AS first FROM rna_{_t}) WHERE first = 1")
TABLES["rna_paths"] = ("", """SELECT DISTINCT sample, contig, strand, list_concat(list_reverse(p.path), q.path) AS path FROM rna_edges e JOIN rna_best_back p USING (sample, contig, strand) JOIN rna_best_forth q USING (sample, contig, strand)
    WHERE p.v = e.u AND q.v = e.v UNION ALL SELECT sample, contig, strand, [start] FROM rna_nodes n
    WHERE NOT EXISTS (SELECT 1 FROM rna_edges e WHERE e.sample = n.sample AND e.contig = n.contig AND e.strand = n.strand AND (e.u = n.start OR e.v = n.start))""")
TABLES["rna_exons"] = ("", """SELECT sample, contig, strand, path, min(start) AS start, max("end") AS "end" FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY sample, contig, strand, path ORDER BY start ROWS UNBOUNDED PRECEDING) AS exon FROM (
      SELECT p.*, n.start, n."end", CASE WHEN lag(n."end") OVER (PARTITION BY sample, contig, strand, path ORDER BY n.start) = n.start - 1 THEN 0 ELSE 1 END AS fresh
      FROM (SELECT *, unnest(path) AS at FROM rna_paths) p JOIN rna_nodes n USING (sample, contig, strand) WHERE n.start = p.at)) GROUP BY sample, contig, strand, path, exon""")
TABLES["rna_spans"] = ("", """SELECT sample, contig, strand, path, min(start) AS start, max("end") AS "end", string_agg(CAST("end" AS STRING)||'-'||CAST(nx AS STRING), ',' ORDER BY start) AS introns
    FROM (SELECT *, lead(start) OVER (PARTITION BY sample, contig, strand, path ORDER BY start) AS nx FROM rna_exons) GROUP BY sample, contig, strand, path""")
TABLES["rna_models"] = ("", """SELECT contig||'.'||strand||'.'||CAST(start AS STRING)||'-'||coalesce(translate(introns, ',-', '-,')||'-', '')||CAST("end" AS STRING) AS transcript_id, * FROM (
    SELECT contig, strand, introns, min(start) AS start, max("end") AS "end", count(DISTINCT sample) AS n_samples FROM rna_spans WHERE introns IS NOT NULL GROUP BY ALL
    UNION ALL SELECT contig, strand, NULL, min(start), max("end"), count(DISTINCT sample) FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY contig, strand ORDER BY start, "end", sample ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY contig, strand ORDER BY start, "end", sample ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh
        FROM rna_spans WHERE introns IS NULL)) GROUP BY contig, strand, island)""")
TABLES["rna_model_exons"] = ("", """SELECT transcript_id, contig, strand, CAST(split_part(x, '-', 1) AS BIGINT) AS start, CAST(split_part(x, '-', 2) AS BIGINT) AS "end" FROM (
    SELECT *, unnest(string_split(regexp_extract(transcript_id, '[^.]*$'), ',')) AS x FROM (SELECT transcript_id, contig, strand FROM rna_models))""")
TABLES["rna_gene_of"] = ("", """SELECT transcript_id, contig||'.'||strand||'.'||CAST(min(start) OVER (PARTITION BY contig, strand, island) AS STRING) AS gene_id FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY contig, strand ORDER BY start, "end", transcript_id ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY contig, strand ORDER BY start, "end", transcript_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM rna_models))""")
TABLES["rna_levels"] = ("", """SELECT t.sample, e.transcript_id, CAST((CAST(coalesce(n_frag, 0) AS HUGEINT) * 1000000000000) // (CAST(e.length AS HUGEINT) * total) AS BIGINT) AS milli_fpkm
    FROM (SELECT transcript_id, CAST(sum("end" - start + 1) AS BIGINT) AS length FROM rna_model_exons GROUP BY ALL) e CROSS JOIN (SELECT sample, count(DISTINCT name) AS total FROM rna_blocks GROUP BY ALL) t
    LEFT JOIN (SELECT h.sample, x.transcript_id, count(DISTINCT h.name) AS n_frag FROM rna_model_exons x JOIN rna_blocks h
      ON h.contig = x.contig AND h.strand = x.strand AND h.start <= x."end" AND h."end" >= x.start GROUP BY ALL) f ON f.sample = t.sample AND f.transcript_id = e.transcript_id""")
TABLES["study_amounts"] = ("", "SELECT gene_id, CASE WHEN sample IN ('1', '2') THEN 'T1' ELSE 'T2' END AS condition, CAST(sum(milli_fpkm) AS BIGINT) AS amount FROM rna_levels JOIN rna_gene_of USING (transcript_id) GROUP BY sample, gene_id")
TABLES["study_tests"] = ("", TABLES["tests"][1].replace("test_amounts", "study_amounts"))
TABLES["study_qvalues"] = ("", TABLES["qvalues"][1].replace("FROM tests", "FROM study_tests"))
TABLES["study_exons"] = ("", 'SELECT transcript_id, contig, strand, start, "end" FROM rna_model_exons UNION ALL SELECT transcript_id, contig, strand, start, "end" FROM rna_ref_exons')
TABLES["study_query_exons"] = ("", "SELECT * FROM study_exons WHERE transcript_id NOT LIKE 'R%'")
TABLES["study_ref_exons"] = ("", "SELECT * FROM study_exons WHERE transcript_id LIKE 'R%'")
for _t in ("chains", "junctions", "classes"):
    TABLES[f"study_{_t}"] = ("", re.sub(r"\b(FROM|JOIN) (exons|chains|junctions|query_exons|ref_exons)\b", r"\1 study_\2", TABLES[_t][1]))


#: Derived tables that many queries read, several times each: written once a session, as a user's own would be.
STORED = ("placed_reads", "worn_reads", "exons", "rna_reads")
_paths: dict[tuple[str, str, str], str] = {}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given or derived table of ``sf_dir``."""
    if name in GIVEN:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _paths:
        return spark.read.parquet(_paths[key])
    entry = TABLES[name]
    text = (entry if isinstance(entry, str) else entry[0]).replace('"end"', "`end`")
    used = [t for t in (*GIVEN, *TABLES) if re.search(rf"(FROM|JOIN) {t}\b", text)]
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    df = spark.sql(text, **{t: frame(spark, sf_dir, t) for t in used})
    if name in STORED:
        path = scratch(spark, name)
        store(df, path)
        _paths[key] = path
        return spark.read.parquet(path)
    return df


def sql(statement: str) -> str:
    """``statement`` for DuckDB, after the derived tables that it needs."""
    needed: dict[str, str] = {}
    met: set[str] = set()

    def need(text: str) -> None:
        for name, entry in TABLES.items():
            if name not in met and re.search(rf"\b(FROM|JOIN) {name}\b|, {name}\b", text):
                met.add(name)
                own = entry if isinstance(entry, str) else entry[1]
                need(own)
                needed[name] = own

    need(statement)
    recursive = any(re.search(rf"\bFROM {n}\b", t) for n, t in needed.items())
    return (f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(f"{n} AS ({t})" for n, t in needed.items()) + "\n" if needed else "") + statement
