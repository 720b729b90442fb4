"""Run parameters and fixed reference values.

Everything a model needs that is not data: the as-of date (never the wall
clock inside tested queries), business thresholds, and the small seed tables
(store master, region config, city / neighbourhood names).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Dates of the adapted driver data run 2026-01-01 .. 2026-03-01.
DEFAULT_AS_OF = dt.date(2026, 3, 1)


@dataclass(frozen=True)
class Params:
    as_of: dt.date = DEFAULT_AS_OF
    # hot-deal thresholds (fct_active_promotions / fct_hot_deals_validated)
    hot_deal_pct: float = 30.0
    min_hot_deal_pct: float = 20.0
    suspicious_pct: float = 70.0
    optimal_low_pct: float = 20.0
    optimal_high_pct: float = 50.0
    recommended_min_score: int = 70
    persistence_rows: int = 7
    # snapshot window for reports (days back from as_of)
    snapshot_days: int = 7
    # run volume check
    min_run_volume: int = 500


DEFAULT = Params()

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the reference's seeds and mappings for the same
# results. Stated as plain text, in their natural order.
# ---------------------------------------------------------------------------

# Store master: store_id, store_name, store_type, coverage_states, is_active,
# region_count, website_url
STORE_SEED = [
    ("bistek", "Bistek Supermercados", "supermarket", "SC/RS", True, 13, "https://www.bistek.com.br"),
    ("fort", "Fort Atacadista", "wholesale", "SC", True, 7, "https://www.fortatacadista.com.br"),
    ("giassi", "Giassi Supermercados", "hypermarket", "SC", True, 17, "https://www.giassi.com.br"),
    ("carrefour", "Carrefour", "hypermarket", "SC", True, 5, "https://mercado.carrefour.com.br"),
    ("angeloni", "Angeloni", "supermarket", "SC/PR", True, 3, "https://www.angeloni.com.br"),
]

STORE_TYPE_DESCRIPTION = {
    "hypermarket": "Large format (>2500m²)",
    "supermarket": "Medium format (500-2500m²)",
    "wholesale": "Cash & carry format",
}

# Regions the adapter deals rows to (region code, postal code, sales channel, hub id).
REGION_SEED = [
    ("florianopolis_costeira", "88047-010", "1", "v2.1E10CE150EA319FED789DC6BE7C290F5"),
    ("florianopolis_santa_monica", "88035-000", "1", None),
    ("blumenau_itoupava", "89052-050", "1", "v2.314053D5BCFB5A6D4C5EA7ED6DF3C455"),
    ("saojose_belavista", "88110-798", "1", "v2.471E6D82FC2AF1E3546612023788DC31"),
    ("poa_nilo", "90470-000", "1", "v2.5549A69410A3F0219D7BCDA860C9D267"),
    ("poa_guadix", "91770-010", "1", "v2.C59E7778E80DE611066F17ABDE1DDCCE"),
    ("balneario_camboriu", "88330-110", "1", "v2.D55FE45FC956CF3452F53FF1829D38B9"),
    ("joinville_aventureiro", "89226-000", "1", "v2.D64E8C3CDDA81BB086AFE28286D484E6"),
]

# Region configuration of each store: region code -> (postal code, sales channel, hub id).
STORE_REGIONS = {
    "bistek": {
        "florianopolis_costeira": ("88047-010", "1", "v2.1E10CE150EA319FED789DC6BE7C290F5"),
        "criciuma_centro": ("88802-000", "1", "v2.1ACA29C622CF7C99ED59045C6074B6C9"),
        "lages_coral": ("88523-000", "1", "v2.191BE3A849CD16A9CEFF2AB55E90E6D7"),
        "blumenau_itoupava": ("89052-050", "1", "v2.314053D5BCFB5A6D4C5EA7ED6DF3C455"),
        "itajai_saojoao": ("88304-101", "1", "v2.2FD273C409C15EF7E16637C23820F3AB"),
        "saojose_belavista": ("88110-798", "1", "v2.471E6D82FC2AF1E3546612023788DC31"),
        "brusque_saoluiz": ("88350-210", "1", "v2.B8B2CA3F13B9BBBEF48E30DF6FB1C5C3"),
        "palhoca_passavinte": ("88132-149", "1", "v2.03F2FCD02C257443A10705733B2AD7ED"),
        "poa_guadix": ("91770-010", "1", "v2.C59E7778E80DE611066F17ABDE1DDCCE"),
        "poa_nilo": ("90470-000", "1", "v2.5549A69410A3F0219D7BCDA860C9D267"),
        "torres_centro": ("95560-000", "1", "v2.BEDC77227E6E64A871B09C032812BAA7"),
        "balneario_camboriu": ("88330-110", "1", "v2.D55FE45FC956CF3452F53FF1829D38B9"),
        "joinville_aventureiro": ("89226-000", "1", "v2.D64E8C3CDDA81BB086AFE28286D484E6"),
    },
    "fort": {
        "balneario_camboriu": ("88330-110", "6", None),
        "itajai_saojoao": ("88304-101", "4", None),
        "blumenau_itoupava": ("89052-050", "5", "v2.1BB18CE648B5111D0933734ED83EC783"),
        "florianopolis_costeira": ("88047-010", "2", "v2.1BB18CE648B5111D0933734ED83EC783"),
        "palhoca_passavinte": ("88132-149", "3", "v2.1BB18CE648B5111D0933734ED83EC783"),
        "saojose_belavista": ("88110-798", "3", "v2.1BB18CE648B5111D0933734ED83EC783"),
        "porto_belo": ("88210-000", "1", "v2.1BB18CE648B5111D0933734ED83EC783"),
    },
    "giassi": {
        "florianopolis_santa_monica": ("88035-000", "1", None),
        "joinville_america": ("89204-000", "1", None),
        "blumenau_victor_konder": ("89012-000", "1", None),
        "palhoca_pagani": ("88132-000", "1", None),
        "florianopolis_sacogrande": ("88032-005", "1", "v2.7F2A3943DBF84750AACFC84F88A37547"),
        "sao_jose_areias": ("88113-600", "1", "v2.ABCBB60D0ACAFE91572B611D519E9FB8"),
        "joinville_bucarein": ("89202-310", "1", "v2.3F129C77C9E351893874B20DA972497D"),
        "jaragua_centro": ("89251-000", "1", "v2.F7650946A1CE616593F5473A688636B9"),
        "tubarao_oficinas": ("88701-000", "1", "v2.B38B0AA3929BDF670A0DB9B723107C2E"),
        "tubarao_vila_moema": ("88705-001", "1", "v2.B38B0AA3929BDF670A0DB9B723107C2E"),
        "icara_centro": ("88820-000", "1", "v2.05909B625571D35E8E2AB27B22D4BE56"),
        "criciuma_santa_barbara": ("88804-000", "1", "v2.05909B625571D35E8E2AB27B22D4BE56"),
        "criciuma_centenario": ("88801-001", "1", "v2.05909B625571D35E8E2AB27B22D4BE56"),
        "ararangua_centro": ("88900-045", "1", "v2.7515F347D55C9E8D142E1F03D061CB4E"),
        "ararangua_cidade_alta": ("88901-026", "1", "v2.7515F347D55C9E8D142E1F03D061CB4E"),
        "morro_da_fumaca": ("88830-000", "1", "v2.1BB18CE648B5111D0933734ED83EC783"),
        "sombrio_centro": ("88960-000", "1", "v2.1BB18CE648B5111D0933734ED83EC783"),
    },
    "carrefour": {
        "florianopolis_centro": ("88010-000", "1", None),
        "florianopolis_trindade": ("88036-003", "1", None),
        "saojose_kobrasol": ("88102-600", "1", None),
        "palhoca_pedra_branca": ("88137-270", "1", None),
        "joinville_centro": ("89201-400", "1", None),
    },
    "angeloni": {
        "florianopolis_centro": ("88010-000", "1", "v2.6470C9DD8410520F44B2C757ECBDE327"),
        "florianopolis_continente": ("88085-000", "1", "v2.6EA065AD64AA626F42DFCA6CBE33D035"),
        "saojose_kobrasol": ("88102-000", "1", "v2.6470C9DD8410520F44B2C757ECBDE327"),
    },
    "superkoch": {"balneario_camboriu": ("88340-152", None, None)},
    "hippo": {"florianopolis_centro": ("88015-420", None, None)},
}

# dim_region city names (keyed by the part before the first underscore)
REGION_CITY_NAMES = [
    ("florianopolis", "Florianópolis"),
    ("criciuma", "Criciúma"),
    ("saojose", "São José"),
    ("torres", "Torres"),
    ("itajai", "Itajaí"),
    ("brusque", "Brusque"),
    ("palhoca", "Palhoça"),
    ("lages", "Lages"),
    ("blumenau", "Blumenau"),
    ("poa", "Porto Alegre"),
    ("joinville", "Joinville"),
    ("balneario", "Balneário Camboriú"),
]
REGION_RS_CITIES = ["poa", "torres"]
MAJOR_CITIES = ["Florianópolis", "Porto Alegre", "Joinville", "Blumenau"]

# dim_location city names (keys may contain underscores)
LOCATION_CITY_NAMES = [
    ("florianopolis", "Florianópolis"),
    ("saojose", "São José"),
    ("palhoca", "Palhoça"),
    ("biguacu", "Biguaçu"),
    ("sao_jose", "São José"),
    ("joinville", "Joinville"),
    ("jaragua", "Jaraguá do Sul"),
    ("araquari", "Araquari"),
    ("blumenau", "Blumenau"),
    ("itajai", "Itajaí"),
    ("balneario_camboriu", "Balneário Camboriú"),
    ("navegantes", "Navegantes"),
    ("brusque", "Brusque"),
    ("gaspar", "Gaspar"),
    ("porto_belo", "Porto Belo"),
    ("tubarao", "Tubarão"),
    ("criciuma", "Criciúma"),
    ("ararangua", "Araranguá"),
    ("icara", "Içara"),
    ("laguna", "Laguna"),
    ("imbituba", "Imbituba"),
    ("morro_da_fumaca", "Morro da Fumaça"),
    ("sombrio", "Sombrio"),
    ("chapeco", "Chapecó"),
    ("xanxere", "Xanxerê"),
    ("concordia", "Concórdia"),
    ("sao_miguel_do_oeste", "São Miguel do Oeste"),
    ("lages", "Lages"),
    ("sao_joaquim", "São Joaquim"),
    ("campos_novos", "Campos Novos"),
    ("poa", "Porto Alegre"),
    ("canoas", "Canoas"),
    ("torres", "Torres"),
    ("tramandai", "Tramandaí"),
    ("capao_da_canoa", "Capão da Canoa"),
]
LOCATION_NEIGHBORHOOD_NAMES = [
    ("costeira", "Costeira do Pirajubaé"),
    ("santa_monica", "Santa Mônica"),
    ("sacogrande", "Saco Grande"),
    ("centro", "Centro"),
    ("trindade", "Trindade"),
    ("campeche", "Campeche"),
    ("lagoa", "Lagoa da Conceição"),
    ("belavista", "Bela Vista"),
    ("areias", "Areias"),
    ("kobrasol", "Kobrasol"),
    ("america", "América"),
    ("aventureiro", "Aventureiro"),
    ("bucarein", "Bucarein"),
    ("itoupava", "Itoupava"),
    ("victor_konder", "Victor Konder"),
    ("saojoao", "São João"),
    ("fazenda", "Fazenda"),
    ("oficinas", "Oficinas"),
    ("vila_moema", "Vila Moema"),
    ("santa_barbara", "Santa Bárbara"),
    ("centenario", "Centenário"),
    ("passavinte", "Passa Vinte"),
    ("pagani", "Pagani"),
]
LOCATION_RS_CITIES = ["poa", "canoas", "torres", "tramandai", "capao_da_canoa"]

# Hot-deal labels
PROMOTION_TYPES = [
    (50, "Hot Deal (50%+)"),
    (30, "Strong Discount (30-50%)"),
    (15, "Moderate Discount (15-30%)"),
    (5, "Light Discount (5-15%)"),
]
PROMOTION_TYPE_OTHER = "Minimal Discount (<5%)"
FLAG_EXTREME = "🚨 Extreme Discount (>70%)"
FLAG_INVALID = "❌ Invalid Pricing"
FLAG_FLASH = "⚡ Flash Deal (1 day)"
FLAG_LOW_QUALITY = "⚠️  Low Quality Score"

# Location analyses: coverage status and competition levels
COVERAGE_ABSENT, COVERAGE_PRESENT = "Ausente", "Presente"
COMPETITION_LEVELS = [(3, "Alta competição"), (2, "Competição média")]
COMPETITION_OTHER = "Monopólio local"
# Price category of the serving table (below 5, below 20, else)
PRICE_CATEGORIES = [(5, "Budget"), (20, "Mid-Range")]
PRICE_CATEGORY_OTHER = "Premium"

# Nutrition grade -> quality label
NUTRITION_QUALITY = [("a", "Excellent"), ("b", "Excellent"), ("c", "Good"), ("d", "Fair"), ("e", "Poor")]

# Adapter: store and region assigned from driver keys (index = key mod len).
ADAPTER_STORES = ["angeloni", "bistek", "carrefour", "fort", "giassi"]
ADAPTER_REGIONS = [r[0] for r in REGION_SEED]
