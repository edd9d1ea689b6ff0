"""Registered queries: one per operator, each over whole tables.

``QUERIES`` maps a key to a function of (session, table folder); ``ORACLES`` maps
it to the same result in plain SQL. An oracle states what the operator must
find in the derived input, mostly from the ad itself and not by searching the
rendered page again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.plans.corpus import group_element, with_inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, inputs: list[str] | None = None, sql: str | None = None):
    """Register a query under ``key`` with its SQL over tables and derived inputs."""

    def keep(query: Query) -> Query:
        QUERIES[key] = query
        if sql:
            ORACLES[key] = with_inputs(inputs, sql) if inputs else sql
        return query

    return keep


def col_list(columns: list[str]) -> str:
    return ", ".join(columns)


def big(*columns: str) -> list[Column]:
    return [F.col(c).cast("bigint").alias(c) for c in columns]


QUEUE_DOMAIN = """CASE WHEN contains(url, 'vivareal.com.br') THEN 'vivareal.com.br'
  WHEN contains(url, 'imovelweb.com.br') THEN 'imovelweb.com.br'
  WHEN contains(url, 'olx.com.br') THEN 'olx.com.br'
  WHEN contains(url, 'zapimoveis.com.br') THEN 'zapimoveis.com.br'
  WHEN contains(url, 'mercadolivre.com.br') THEN 'mercadolivre.com.br' ELSE 'outro' END"""

# What the main extractor must find on the rendered page of each ad.
EX_START = r"substr(regexp_replace(html, '\s+', ' ', 'g'), 1, 150)"
LD_PRICE = """CASE WHEN a.list_id % 4 = 0 THEN CASE WHEN valor IS NOT NULL THEN 'R$ ' || valor
  WHEN preco = 'Sob consulta' THEN preco END ELSE nullif(preco, '') END"""
LINE_OK = "endereco IS NOT NULL AND cidade IS NOT NULL"


CHALLENGE_TITLE = "CASE a.list_id % 20 WHEN 7 THEN NULL WHEN 11 THEN 'Busca' ELSE 'Just a moment...' END"


def _line(column: str, value: str | None = None) -> str:
    return (
        f"CASE a.list_id % 4 WHEN 2 THEN CASE WHEN {LINE_OK} THEN {value or column} END"
        f" WHEN 3 THEN NULL ELSE {column} END AS {column}"
    )


EXTRACTED = f"""(SELECT a.list_id AS page_id, p.url AS link,
  CASE WHEN p.url LIKE '%/sem-link/%' THEN 'OLX' ELSE fonte END AS fonte,
  CASE a.list_id % 4 WHEN 2 THEN CASE WHEN a.list_id % 12 = 2 AND titulo IS NOT NULL THEN NULL ELSE coalesce(titulo, 'Sem titulo') END
    WHEN 3 THEN {CHALLENGE_TITLE} ELSE coalesce(titulo, {EX_START}) END AS titulo,
  CASE a.list_id % 4 WHEN 2 THEN CASE WHEN valor IS NOT NULL AND a.list_id % 12 <> 10
      THEN CASE WHEN a.list_id % 12 = 6 THEN replace(preco, 'R$ ', 'R$') ELSE preco END || ',' END WHEN 3 THEN NULL
    ELSE {LD_PRICE} END AS preco,
  CASE WHEN a.list_id % 4 = 2 THEN replace(metragem, '12000', '2000') END AS metragem,
  CASE WHEN a.list_id % 4 = 2 THEN quartos END AS quartos,
  CASE WHEN a.list_id % 4 = 2 THEN banheiros END AS banheiros,
  CASE WHEN a.list_id % 4 <> 3 AND a.list_id % 12 <> 2 THEN resumo || CASE WHEN a.list_id % 12 = 6 THEN ' d' ELSE '' END END AS descricao,
  {_line('endereco')}, {_line('cidade')}, {_line('estado', 'upper(estado)')},
  CASE WHEN a.list_id % 4 <> 3 THEN cep END AS cep,
  CASE a.list_id % 4 WHEN 2 THEN coalesce(contato, CASE WHEN a.list_id % 24 = 18 THEN '11 9' ELSE '+55-11-' END || a.list_id) WHEN 3 THEN NULL
    ELSE contato END AS contato,
  a.list_id % 4 AS layout
  FROM ads a JOIN ad_pages p ON a.list_id = p.page_id
  WHERE CASE a.list_id % 4 WHEN 2 THEN true WHEN 3 THEN a.list_id % 20 <> 7
    ELSE titulo IS NOT NULL OR {LD_PRICE} IS NOT NULL OR endereco IS NOT NULL END)"""
EX_KEY = "md5(coalesce(titulo, 'None') || coalesce(preco, 'None') || coalesce(link, 'None'))"
EX_FIELDS = [
    "titulo", "preco", "metragem", "quartos", "banheiros", "descricao", "endereco", "cidade",
    "estado", "cep", "contato", "link",
]

PLACED = (
    "(SELECT keyword, "
    + "CASE " + " ".join(f"WHEN contains(k, '{c}') THEN '{c}'" for c, _ in C.CITY_UF) + " ELSE 'curitiba' END AS cidade, "
    + "CASE " + " ".join(f"WHEN contains(k, '{c}') THEN '{uf}'" for c, uf in C.CITY_UF) + " ELSE 'PR' END AS estado, "
    + "CASE " + " ".join(f"WHEN contains(k, '{t}') THEN '{t}'" for t in C.PROPERTY_TYPES) + " ELSE 'apartamento' END AS tipo "
    + "FROM (SELECT keyword, translate(lower(keyword), 'áàâãäéèêëíìîïóòôõöúùûüçñ', 'aaaaaeeeeiiiiooooouuuucn') AS k FROM keywords))"
)
CAPTURE_PATTERN = C.CAPTURE_AD_PLAIN
CAPTURE_NAMES = ["list_id", "ad_url", "preco", "titulo", "cidade", "estado"]
CAPTURE_ADS = (
    "(SELECT entry_id, pos, "
    + ", ".join(f"regexp_extract(m, '{CAPTURE_PATTERN}', {i}) AS {n}" for i, n in enumerate(CAPTURE_NAMES, 1))
    + " FROM (SELECT entry_id, unnest(range(len(ms))) AS pos, unnest(ms) AS m FROM (SELECT entry_id, "
    + f"regexp_extract_all(text, '{CAPTURE_PATTERN}') AS ms FROM captures WHERE status = 200 AND length(text) > 0)))"
)

AD_LENGTH = """length('{"list_id":' || list_id || ',"images":[{"alt":"a {b]"}]'
  || coalesce(',"ad_url":"' || link || '"', '') || coalesce(',"price":"' || nullif(preco, '') || '"', '')
  || coalesce(',"subject":"' || titulo || '"', '') || coalesce(',"municipality":"' || cidade || '"', '')
  || coalesce(',"state_uf":"' || estado || '"', '') || '}')"""
GROUP_LENGTH = f"CASE WHEN c.entry_id % 2 = 0 THEN length({group_element('c.entry_id')}) ELSE 0 END"
# Where each ad ends in its payload, to tell the ads that survive the cut.
WHOLE_ADS = f"""(SELECT * FROM (SELECT a.*, c.entry_id, c.status, length(c.text) AS kept,
    1 + {GROUP_LENGTH}
    + sum({AD_LENGTH} + CASE WHEN list_id % 20 = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY c.entry_id ORDER BY list_id) AS ends
    FROM ads a JOIN captures c ON a.list_id // 20 = c.entry_id) WHERE ends <= kept)"""
# One URL per ad: the deep one, whole ads in order, then what the cut-off rest still shows.
FOUND_AD_URLS = f"""(SELECT entry_id, 0 AS pos, 'https://www.olx.com.br/fundo/' || entry_id AS url FROM captures WHERE entry_id % 2 = 0
  UNION ALL
  SELECT entry_id, row_number() OVER (PARTITION BY entry_id ORDER BY list_id) - entry_id % 2 AS pos,
    coalesce(link, 'https://www.olx.com.br/vi/' || list_id) AS url FROM {WHOLE_ADS}
  UNION ALL
  SELECT entry_id, whole + 1 - entry_id % 2 + unnest(range(len(found))) AS pos, unnest(found) AS url FROM (
    SELECT entry_id, whole, CASE WHEN len(regexp_extract_all(tail, '"ad_url":"(https?://[^"]+)"', 1)) > 0
        THEN regexp_extract_all(tail, '"ad_url":"(https?://[^"]+)"', 1)
        ELSE list_transform(regexp_extract_all(tail, '"list_id":(\\d+)', 1), lambda n: 'https://www.olx.com.br/vi/' || n) END AS found
    FROM (SELECT c.entry_id, coalesce(w.whole, 0) AS whole, substr(c.text, CAST(coalesce(w.done, 1 + {GROUP_LENGTH}) + 1 AS BIGINT)) AS tail
      FROM captures c LEFT JOIN (SELECT entry_id, count(*) AS whole, max(ends) AS done FROM {WHOLE_ADS} GROUP BY entry_id) w
      ON c.entry_id = w.entry_id)))"""
