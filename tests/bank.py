"""A small bank: seed products, invented customers and acquisitions, and what must come out."""

# The seed products (key, name, category, credit limit).
PRODUCTS = [
    (1, "Conta Corrente Básica", "Conta Corrente", None),
    (2, "Conta Corrente Premium", "Conta Corrente", None),
    (3, "Conta de Poupança", "Poupança", None),
    (4, "Cartão de Crédito Gold", "Cartão de Crédito", "5000.00"),
    (5, "Empréstimo Pessoal", "Empréstimo", "20000.00"),
    (6, "Seguro de Vida", "Seguro", None),
    (7, "CDB de Curto Prazo", "Investimento", "1000.00"),
    (8, "CDB de Longo Prazo", "Investimento", "5000.00"),
    (9, "Investimento em Ações", "Investimento", "1000.00"),
    (10, "Plano de Previdência", "Previdência", "500.00"),
    (11, "Financiamento Imobiliário", "Financiamento", "300000.00"),
    (12, "Cheque Especial", "Conta Corrente", "10000.00"),
    (13, "Linha de Crédito Empresarial", "Crédito Empresarial", "50000.00"),
    (14, "Plano de Saúde Empresarial", "Saúde", None),
    (15, "Plano de Saúde Familiar", "Saúde", None),
    (16, "Cartão de Crédito Platinum", "Cartão de Crédito", "10000.00"),
    (17, "Conta Digital", "Conta Corrente", None),
    (18, "Empréstimo Consignado", "Empréstimo", "15000.00"),
    (19, "Seguro de Automóvel", "Seguro", None),
    (20, "Investimento em Fundos", "Investimento", "2000.00"),
    (21, "Financiamento de Veículo", "Financiamento", "50000.00"),
    (22, "Empréstimo com Garantia", "Empréstimo", "30000.00"),
    (23, "Conta Universitária", "Conta Corrente", None),
    (24, "Plano de Previdência Individual", "Previdência", "1000.00"),
    (25, "CDB de Liquidez Diária", "Investimento", "2000.00"),
    (26, "Seguro de Saúde", "Seguro", None),
    (27, "Linha de Crédito Imobiliário", "Crédito Imobiliário", "100000.00"),
    (28, "Cartão de Crédito Classic", "Cartão de Crédito", "3000.00"),
    (29, "Investimento em Ouro", "Investimento", "1000.00"),
    (30, "Financiamento para Reforma", "Financiamento", "20000.00"),
    (31, "Conta Corrente Universitária", "Conta Corrente", None),
    (32, "Empréstimo de Automóvel", "Empréstimo", "15000.00"),
    (33, "Plano de Saúde Familiar", "Saúde", None),
    (34, "Investimento em Ações de Tecnologia", "Investimento", "2000.00"),
    (35, "Financiamento para Estudo", "Financiamento", "30000.00"),
    (36, "CDB de Médio Prazo", "Investimento", "3000.00"),
    (37, "Plano de Previdência Empresarial", "Previdência", "2000.00"),
    (38, "Cartão de Crédito Empresarial", "Cartão de Crédito", "20000.00"),
    (39, "Seguro Residencial", "Seguro", None),
    (40, "Empréstimo Estudantil", "Empréstimo", "10000.00"),
    (41, "Financiamento de Equipamentos", "Financiamento", "25000.00"),
    (42, "Investimento em Títulos Públicos", "Investimento", "5000.00"),
    (43, "Plano de Saúde para Idosos", "Saúde", None),
    (44, "Conta de Investimento", "Conta Corrente", "5000.00"),
    (45, "CDB de Longo Prazo", "Investimento", "5000.00"),
    (46, "Seguro de Vida para Famílias", "Seguro", None),
    (47, "Empréstimo Imobiliário", "Empréstimo", "150000.00"),
    (48, "Plano de Previdência para Idosos", "Previdência", "1000.00"),
    (49, "Investimento em Criptomoedas", "Investimento", "1000.00"),
    (50, "Financiamento para Estudo Superior", "Financiamento", "20000.00"),
]

# key, document, birth date, marital status, gender, state, income, kind
CUSTOMERS = [
    ("1", "00000000001", "1990-04-16", "solteiro", "F", "SP", "521", "PF"),
    ("2", "00000000002", "2000-01-01", "casado", "M", "RJ", "521.50", "PF"),
    ("3", "00000000003", "1985-12-31", "casado", "F", "MG", "522", "PF"),
    ("4", "00000000004", "2020-04-16", "viuvo", "M", "SP", "1042", "PF"),
    ("5", "00000000005", "1970-06-15", "casado", "F", "BA", "1043", "PF"),
    ("6", "00000000006", "sem data", "solteiro", "M", "SP", "4427", "PF"),
    ("7", "00000000007", "1999-09-09", "solteiro", "F", "RS", "4428", "PF"),
    ("8", "00000000008", "1960-02-29", "viuvo", "M", "SP", "8856", "PF"),
    ("9", "00000000009", "1995-05-05", "casado", "F", "PE", "8857", "PJ"),
    ("10", "00000000010", "1988-08-08", "casado", "M", "SP", " NULL ", "PJ"),
]

# key, customer, product, amount; product 99 and customer 77 are unknown.
ACQUISITIONS = [
    ("1", "1", "8", "100.10"),
    ("2", "2", "45", "200.20"),
    ("3", "3", "8", "0.05"),
    ("4", "4", "4", "1500.00"),
    ("5", "5", "4", "2500.00"),
    ("6", "6", "1", "10.00"),
    ("7", "7", "99", "20.00"),
    ("8", "77", "12", "333.33"),
    ("9", "8", "47", "99999.99"),
    ("10", "9", "10", "12.345"),
    ("11", "10", "10", "sem valor"),
    ("12", "1", "4", "0.01"),
]

# What silver must hold for load date 20250416: customer, product name, class, age, amount.
SILVER = [
    ("1", "CDB de Longo Prazo", "Classe E", "35", "100.10"),
    ("2", "CDB de Longo Prazo", "Classe E", "25", "200.20"),
    ("3", "CDB de Longo Prazo", "Classe D", "39", "0.05"),
    ("4", "Cartão de Crédito Gold", "Classe D", "4", "1500.00"),
    ("5", "Cartão de Crédito Gold", "Classe C", "54", "2500.00"),
    (None, "Cheque Especial", "Classe A", None, "333.33"),
    ("8", "Empréstimo Imobiliário", "Classe B", "65", "99999.99"),
    ("9", "Plano de Previdência", "Classe A", "29", "12.345"),
    ("10", "Plano de Previdência", "Classe A", "36", "sem valor"),
    ("1", "Cartão de Crédito Gold", "Classe E", "35", "0.01"),
]

# What gold must hold: product name, sum of amounts, sum of limits.
GOLD = [
    ("CDB de Longo Prazo", 300.35, 15000.0),
    ("Cartão de Crédito Gold", 4000.01, 15000.0),
    ("Cheque Especial", 333.33, 10000.0),
    ("Empréstimo Imobiliário", 99999.99, 150000.0),
    ("Plano de Previdência", 12.35, 1000.0),
]


def customers(spark):
    names = "client_id cpf data_nascimento est_civil genero estado renda tp_cliente".split()
    schema = ", ".join(f"{name} string" for name in names)
    return spark.createDataFrame(CUSTOMERS, schema)


def products(spark):
    rows = [(str(key), name, name, category, limit) for key, name, category, limit in PRODUCTS]
    schema = "produto_id string, nome string, descricao string, categoria string"
    return spark.createDataFrame(rows, f"{schema}, limite_credito string")


def acquisitions(spark):
    schema = "id string, cliente_id string, produto_id string, valor_aquisicao string"
    return spark.createDataFrame(ACQUISITIONS, schema)
