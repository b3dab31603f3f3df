"""The shipped topic domains, their texts and codes.

Everything in this file has to equal the published values for results to agree.
"""

# How a processed status row got its result.
METHOD_BLANK = "VACIO"
METHOD_KEYWORDS = "KEYWORDS"
METHOD_MODEL = "IA"

# The answer for "not this domain".
NOT_APPLICABLE = "NO_APLICA"

# Label that a generative answer may carry in front of the category.
ANSWER_LABEL = "Respuesta:"

# Prefix of the predicted label of a failed evaluation.
ERROR_LABEL = "ERROR"

# Characters of the text that fit a generative prompt and a choice request.
PROMPT_CHARS = 600
CHOICE_CHARS = 800

# Categories of each domain, in matching order.
CATEGORIES = {
    "ruido": [
        "Ruido por actividades lúdicas",
        "Ruido por comercio (comercio - bar, comercio - gastrobar)",
        "Ruido por construcción",
        "Ruido por industria",
        "Ruido por servicios",
        "Ruido por tráfico aéreo",
        "Ruido por tráfico vehicular",
        "Ruido por vecinos",
        "Ruido por ventas ambulantes",
        "Ruido sin especificar",
    ],
    "salud": [
        "Fallas en la prestación del servicio/humanización del servicio",
        "Negación de citas médicas",
        "Negación de Medicamentos",
        "Negación de procedimientos",
        "Otros",
    ],
    "maltrato_animal": ["Maltrato Animal"],
}

# Words that a text must contain to reach the engine, when the keyword filter is on.
KEYWORDS = {
    "maltrato_animal": [
        "animal", "animales", "perro", "perros", "canino", "caninos",
        "gato", "gatos", "felino", "felinos", "mascota", "mascotas",
        "maltrato", "crueldad", "abandono", "encerrado", "encerrados",
        "golpe", "golpes", "desnutrido", "desnutricion", "herido",
        "zoonosis", "fauna", "cachorro", "cachorros",
    ],
}

# Prompt sent to a generative engine.
PROMPT_TEMPLATES = {
    "maltrato_animal": """Eres un asistente experto en clasificación de PQRS (Peticiones, Quejas, Reclamos y Sugerencias).
Tu tarea es analizar el siguiente 'Asunto' y determinar si corresponde a denuncias o situaciones de '{clase_upper}'.

El '{clase_upper}' incluye: abandono, agresiones físicas, falta de alimento o agua, encierro indebido, desnutrición, negligencia en salud o bienestar de animales domésticos o silvestres, tenencia en condiciones deplorables o crueldad animal.

Si el asunto NO está relacionado con '{clase_upper}' (o trata de otros trámites, salud humana, ruido, tenencia responsable rutinaria, solicitudes de esterilización preventiva, vacunación sin denuncia de maltrato), responde únicamente con la palabra "NO_APLICA".

Si el asunto SI corresponde a '{clase_upper}', responde con:
{categories_list}

Responde ÚNICAMENTE con el nombre exacto de la categoría o "NO_APLICA". No des explicaciones ni agregues texto adicional.

Asunto: "{asunto}"
Respuesta:""",
}

# Question put to a choice engine: open world (with NO_APLICA) and closed world.
CHOICE_INSTRUCTIONS = (
    "Determinar si el asunto de la petición ciudadana PQRS corresponde a {domain} "
    "y seleccionar la subcategoría adecuada, o 'NO_APLICA'."
)
CLOSED_CHOICE_INSTRUCTIONS = (
    "Determinar la subcategoría adecuada de {domain} para la siguiente petición ciudadana."
)

# Descriptions of the "not this domain" choice; {domain} is the display name.
NOT_APPLICABLE_TEXT = {
    "maltrato_animal": (
        "El asunto NO corresponde a maltrato animal (trata sobre otros trámites, salud humana, "
        "ruido, tenencia responsable rutinaria, vacunación o esterilización preventiva sin "
        "denuncia de maltrato)."
    ),
    "salud": "El asunto NO tiene ninguna relación con el sector salud ni atención médica.",
    "ruido": (
        "El asunto NO tiene relación con quejas o denuncias por ruido o contaminación acústica."
    ),
}
NOT_APPLICABLE_TEXT_OTHER = (
    "El asunto NO está relacionado con {domain} o corresponde a otros temas no pertinentes."
)

# Descriptions of a category: words looked for in its name, first match wins.
CATEGORY_TEXT_BY_WORD = {
    "maltrato_animal": [
        (
            ["maltrato"],
            "Denuncias o situaciones de maltrato, abandono, agresiones físicas, encierro "
            "indebido, desnutrición, falta de auxilio o crueldad hacia animales.",
        ),
    ],
    "salud": [
        (
            ["prestación", "humanización"],
            "Quejas por mala atención, tratos inhumanos, demoras graves o fallas en la "
            "prestación del servicio de salud.",
        ),
        (
            ["citas"],
            "Negación, falta de agenda o trabas para asignación de citas médicas generales o "
            "con especialista.",
        ),
        (
            ["medicamento"],
            "No entrega, desabastecimiento, demoras o negación de medicamentos formulados.",
        ),
        (
            ["procedimiento"],
            "Negación, dilación o falta de autorización de cirugías, exámenes o procedimientos "
            "médicos.",
        ),
        (
            ["otros"],
            "Otras peticiones o quejas vinculadas al sistema de salud que no corresponden a las "
            "categorías anteriores.",
        ),
    ],
}
# Description of a category without a matching word; {category} as written, {lowered} lower-cased.
CATEGORY_TEXT = {
    "maltrato_animal": "El asunto corresponde a {category}.",
    "salud": "El asunto corresponde a {category}.",
    "ruido": "El asunto corresponde a quejas por {lowered}.",
}
CATEGORY_TEXT_OTHER = "El asunto corresponde específicamente a {category}."

# Rows per stratum of the published 1,000-row evaluation sample.
SAMPLE_QUOTAS = {
    ("ruido", "Ruido por actividades lúdicas"): 35,
    ("ruido", "Ruido por comercio (comercio - bar, comercio - gastrobar)"): 35,
    ("ruido", "Ruido por construcción"): 35,
    ("ruido", "Ruido por industria"): 35,
    ("ruido", "Ruido por servicios"): 35,
    ("ruido", "Ruido por tráfico aéreo"): 23,
    ("ruido", "Ruido por tráfico vehicular"): 35,
    ("ruido", "Ruido por vecinos"): 35,
    ("ruido", "Ruido por ventas ambulantes"): 35,
    ("ruido", "Ruido sin especificar"): 47,
    ("salud", "Fallas en la prestación del servicio/humanización del servicio"): 70,
    ("salud", "Negación de citas médicas"): 70,
    ("salud", "Negación de Medicamentos"): 70,
    ("salud", "Negación de procedimientos"): 70,
    ("salud", "Otros"): 70,
    ("maltrato_animal", "Maltrato Animal"): 300,
}
