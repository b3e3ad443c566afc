"""Labels, limits and lookups that results must carry unchanged.

Every one of them is only a default; the operators take them as arguments.
"""

# Company and sector of the listed tickers.
COMPANIES = {
    "PETR4.SA": "Petrobras",
    "VALE3.SA": "Vale",
    "ITUB4.SA": "Itau",
    "BBDC4.SA": "Bradesco",
    "ABEV3.SA": "Ambev",
    "MGLU3.SA": "Magazine Luiza",
    "WEGE3.SA": "WEG",
    "BBAS3.SA": "Banco do Brasil",
}
COMPANY_DEFAULT = "Desconhecido"
SECTORS = {
    "PETR4.SA": "Commodities",
    "VALE3.SA": "Commodities",
    "ITUB4.SA": "Financeiro",
    "BBDC4.SA": "Financeiro",
    "BBAS3.SA": "Financeiro",
    "SANB11.SA": "Financeiro",
    "ABEV3.SA": "Consumo",
    "MGLU3.SA": "Varejo",
    "WEGE3.SA": "Industria",
}
SECTOR_DEFAULT = "Outros"

# Customer CSV header -> canonical name.
CUSTOMER_CSV = {
    "CreditScore": "score_credito",
    "Geography": "pais",
    "Gender": "genero",
    "Age": "idade",
    "Tenure": "anos_cliente",
    "Balance": "saldo",
    "NumOfProducts": "num_produtos",
    "EstimatedSalary": "salario_estimado",
}

# Bands are (operator, limit, label) in order of test, then the default label.
RISK_PROFILE = [(">=", 750, "Arrojado"), (">=", 600, "Moderado")]
RISK_PROFILE_DEFAULT = "Conservador"
BALANCE_BAND = [("==", 0, "Sem saldo"), ("<", 50000, "Baixo"), ("<", 150000, "Medio")]
BALANCE_BAND_DEFAULT = "Alto"
AGE_BAND = [("<", 30, "Jovem"), ("<", 50, "Adulto")]
AGE_BAND_DEFAULT = "Senior"
SCORE_BAND = [(">=", 750, "Excelente"), (">=", 650, "Bom"), (">=", 550, "Regular")]
SCORE_BAND_DEFAULT = "Ruim"
VOLUME_ALERT = [(">", 8000, "Volume Alto"), (">", 5000, "Volume Medio")]
PRICE_ALERT = [(">", 80, "Preco Alto"), ("<", 15, "Preco Baixo")]
ANOMALY_UP = "Alta Anormal"
ANOMALY_DOWN = "Queda Anormal"
NORMAL = "Normal"
CRITICAL_HIGH = ("Critico", "Alto")
TREND = ("Alta", "Queda", "Estavel")
PRESSURE = ("Compra", "Venda", "Neutro")
POSITION = ("Comprado", "Vendido a Descoberto", "Zerado")

# Long-series indicator names.
DAILY_SERIES = ("selic", "cambio_usd_brl", "ipca")
YEARLY_SERIES = ("pib_anual", "desemprego")

GDP_TREND = [(">", 2, "Crescimento Alto"), (">", 0, "Crescimento Moderado"), (">", -2, "Queda Moderada")]
GDP_TREND_DEFAULT = "Queda Severa"
JOBLESS_TREND = [("<", -1, "Melhorando (Rápido)"), ("<", 0, "Melhorando"), ("<", 1, "Piorando")]
JOBLESS_TREND_DEFAULT = "Piorando (Rápido)"
SCENARIO_EXPANSION = "Expansao Economica"
SCENARIO_SLOWDOWN = "Desaceleracao"
SCENARIO_RECESSION = "Recessao"
SCENARIO_OTHER = "Transicao"
SCENARIO_IMPACT = {
    "Expansao Economica": "Positivo - Favoravel para acoes ciclicas",
    "Desaceleracao": "Negativo - Favora acoes defensivas",
    "Recessao": "Muito Negativo - Ouro e defensivas",
}
SCENARIO_IMPACT_DEFAULT = "Neutro"

FX_SENSITIVITY = [
    (">", 0.5, "Alta Positiva (Exportadora)"),
    (">", 0.2, "Moderada Positiva"),
    ("<", -0.5, "Alta Negativa (Importadora)"),
    ("<", -0.2, "Moderada Negativa"),
]
FX_SENSITIVITY_DEFAULT = "Baixa Correlacao"
FX_DECOUPLED = "Sim - Acao se desacoplou do cambio"
FX_COUPLED = "Nao"
FX_BUY = "Comprar - Exportadora com cambio em alta"
FX_SELL = "Vender - Importadora com cambio em alta"
FX_NEUTRAL = "Neutro"

# Weighted risk score.
SCORE_WEIGHTS = (0.4, 0.2, 0.2, 0.2)
PROFILE_POINTS = {"Arrojado": 100, "Moderado": 60}
PROFILE_POINTS_DEFAULT = 30
BALANCE_POINTS = {"Alto": 100, "Medio": 60, "Baixo": 30}
BALANCE_POINTS_DEFAULT = 10
BEHAVIOUR_POINTS = [("<", 20, 100), ("<", 50, 60)]
BEHAVIOUR_POINTS_DEFAULT = 20
RISK_CATEGORY = [(">=", 70, "Baixo Risco"), (">=", 50, "Risco Moderado"), (">=", 30, "Risco Alto")]
RISK_CATEGORY_DEFAULT = "Risco Critico"
RISK_LIMIT = {"Baixo Risco": 500000, "Risco Moderado": 200000, "Risco Alto": 50000}
RISK_LIMIT_DEFAULT = 10000

# Fraud rules: flag column -> predicate.
ORDER_RULES = {
    "alerta_valor_alto": "valor_total > limite_operacional",
    "alerta_volume_suspeito": "quantidade > 9000",
    "alerta_preco_atipico": "preco > 90 or preco < 12",
    "alerta_perfil_incompativel": "perfil_risco = 'Conservador' and valor_total > 200000",
}
TRADE_RULES = {
    "alerta_volume_suspeito": "quantidade > 9000",
    "alerta_preco_atipico": "preco > 90 or preco < 12",
    "alerta_valor_elevado": "valor_total > 500000",
    "alerta_desvio_historico": "abs(preco - preco_medio) > preco_medio * volatilidade / 100 * 2",
}
SEVERITY = [(">=", 3, "Critico"), (">=", 2, "Alto"), (">=", 1, "Medio")]
SEVERITY_ORDER = ("Critico", "Alto", "Medio")

# Trade payload: required fields in order of test, sides, and reasons.
TRADE_SCHEMA = (
    "timestamp string, ticker string, preco double, quantidade bigint, "
    "tipo string, corretora string, id_transacao string"
)
TRADE_FIELDS = ("timestamp", "ticker", "preco", "quantidade", "tipo", "corretora", "id_transacao")
TRADE_SIDES = ("compra", "venda")
REASON_MISSING = "Campo obrigatório faltando: "
REASON_PRICE = "Preço deve ser numérico"
REASON_QUANTITY = "Quantidade deve ser inteiro"
REASON_SIDE = "Tipo inválido: "
REASON_OK = "Schema válido"
REASON_JSON = "JSON inválido"

# Risk/return labels of the performance report.
RISK_RETURN_IDEAL = "Ideal (alto retorno, baixo risco)"
RISK_RETURN_RISKY = "Retorno com risco"
RISK_RETURN_POOR = "Risco sem retorno"

# Quality status.
STATUS_CRITICAL = "CRITICO"
STATUS_ATTENTION = "ATENCAO"
STATUS_OK = "OK"

# Run-log layers by task-id prefix.
TASK_LAYERS = [
    ("t0_", "Setup"),
    ("t1_", "Ingestion"),
    ("t2_", "Silver"),
    ("t3_", "Gold"),
    ("t_sql_", "SQL"),
]
TASK_LAYER_DEFAULT = "Other"

# Tracked column sets of the two history tables.
SCD2_CUSTOMERS = (
    "id_cliente", "hash_cliente", "sobrenome_masked", "perfil_risco", "score_credito",
    "faixa_saldo", "faixa_etaria", "score_categoria", "ativo", "churn",
)
SCD2_RISK_SCORE = (
    "hash_cliente", "perfil_risco", "faixa_saldo", "score_credito", "score_risco",
    "categoria_risco", "limite_operacional", "num_ativos", "total_ordens",
)
OPEN_END = "9999-12-31"
