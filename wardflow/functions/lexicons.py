"""Default Portuguese lexicons for the label sets of the reference queries.

The label sets are fixed by the reference; which terms speak for a label is this library's
own choice. A caller with other texts passes other lexicons.
"""

from __future__ import annotations


def _even(*terms: str) -> dict[str, float]:
    return dict.fromkeys(terms, 1.0)


# Labels are fixed values; the last one of each set is also the default where noted.
PRIORITY = {
    "urgente": {"dor torácica": 3.0, "falta de ar": 3.0, "sudorese": 2.0, "desmaio": 3.0,
                "convulsão": 3.0, "sangramento": 2.0, "urgente": 2.0},
    "alta": {"febre alta": 2.0, "aguda": 2.0, "descontrolada": 2.0, "vômito": 1.0,
             "progressiva": 1.0, "edema": 1.0, "pressão": 1.0},
    "media": {"dor": 1.0, "cefaleia": 1.0, "tonturas": 1.0, "coceira": 1.0, "visão": 1.0,
              "manchas": 1.0, "garganta": 1.0},
    "eletiva": {"rotina": 3.0, "preventivo": 3.0, "check": 2.0, "acompanhamento": 2.0},
}
PRIORITY_DEFAULT = "eletiva"

RISK = {
    "baixo_risco": {"rotina": 3.0, "preventivo": 3.0, "check": 2.0, "garganta": 1.0, "coceira": 1.0},
    "medio_risco": {"febre": 1.0, "cefaleia": 1.0, "lombar": 1.0, "visão": 1.0, "vômito": 1.0,
                    "tonturas": 1.0, "abdominal": 1.0},
    "alto_risco": {"dor torácica": 3.0, "falta de ar": 3.0, "sudorese": 2.0,
                   "descontrolada": 3.0, "hipertensão": 2.0, "edema": 1.0},
}
RISK_DEFAULT = "baixo_risco"
RISK_LEVELS = {"baixo_risco": 0, "medio_risco": 1, "alto_risco": 2}

THEME = {
    "tempo_de_espera": _even("demora", "demorei", "demorou", "espera", "esperei", "esperando",
                             "horas", "hora", "horário", "fila", "atrasou", "atrasaram", "lento",
                             "rápido", "pontual", "pontualidade", "eternidade"),
    "qualidade_medica": _even("médico", "médica", "enfermeira", "consulta", "diagnóstico",
                              "competente", "especialista", "profissionais"),
    "atendimento_recepcao": _even("recepção", "recepcionista", "atendimento", "atendido", "equipe"),
    "infraestrutura": _even("estacionamento", "limpo", "limpa", "estrutura", "ambiente"),
    "sistema_digital": {"sistema": 2.0, "online": 2.0, "app": 2.0, "site": 2.0},
    "outros": {},
}
THEME_DEFAULT = "outros"

CRITICALITY = {
    "problema_critico": _even("urgentes", "urgente", "aumento", "grave", "risco"),
    "problema_atencao": _even("subiu", "reclamações", "instável", "espera", "atraso"),
    "destaque_positivo": _even("referência", "conclusão", "excelente", "melhora"),
    "informativo": {},
}
CRITICALITY_DEFAULT = "informativo"
ACTION = {
    "problema_critico": "Acionar a diretoria e reforçar a equipe hoje.",
    "problema_atencao": "Abrir um plano de ação com prazo de uma semana.",
    "destaque_positivo": "Registrar a prática e levá-la às demais unidades.",
    "informativo": "Acompanhar no próximo relatório.",
}

POSITIVE = ("excelente", "ótimo", "ótimos", "atencioso", "atenciosa", "recomendo", "adorei",
            "perfeito", "impecável", "competente", "rápido", "ágil", "pontual", "pontualidade",
            "satisfeito", "parabéns", "maravilhosa", "simpáticos", "gentil", "humanizado",
            "limpo", "limpa", "valeu", "bem", "confiança", "exemplar", "acolhedor", "muito boa",
            "muito bom", "primeira")
NEGATIVE = ("péssimo", "péssima", "horrível", "absurdo", "absurda", "ruim", "demora", "demorei",
            "demorou", "desorganizada", "decepcionante", "mal", "grosseira", "arrogante",
            "apressado", "insuportável", "frustrante", "lento", "despreparada", "descaso",
            "atrasou", "atrasaram", "travou", "falta", "caro", "não funciona", "não recomendo",
            "esperei", "fila")
