"""Hand-written landed payloads."""

from __future__ import annotations

import json

NOON = 1_717_243_200  # 2024-06-01 12:00:00 UTC
DAY = 86_400


def weather(city_id=1, name="Resende", dt=NOON, **changes):
    body = {
        "id": city_id,
        "name": name,
        "dt": dt,
        "visibility": 9000,
        "coord": {"lon": -44.45, "lat": -22.47},
        "weather": [{"description": "nublado"}, {"description": "chuva"}],
        "main": {
            "temp": 21.5, "feels_like": 22, "temp_min": 20, "temp_max": 23.25,
            "pressure": 1013.7, "humidity": 80,
        },
        "wind": {"speed": 3.5, "deg": 190},
        "sys": {"country": "BR", "sunrise": dt - 3600, "sunset": dt + 3600},
    }
    body.update(changes)
    return {k: v for k, v in body.items() if v is not None}


def leg(metres=1000, **changes):
    body = {
        "start_address": "A", "end_address": "B",
        "distance": {"text": f"{metres / 1000:g} km", "value": metres},
        "duration": {"text": "10 min", "value": 600},
        "steps": [
            {"html_instructions": "vire à direita", "distance": {"text": "1 km", "value": 1000}},
            {"html_instructions": "siga", "travel_mode": "DRIVING"},
        ],
    }
    body.update(changes)
    return {k: v for k, v in body.items() if v is not None}


def directions(origin=(1, "Resende"), destination=(2, "Lavras"), routes=None):
    return {
        "route": {
            "origin": {"nu_cidade": origin[0], "cidade": origin[1]},
            "destination": {"nu_cidade": destination[0], "cidade": destination[1]},
        },
        "routes": [{"legs": [leg()]}] if routes is None else routes,
    }


def landed(spark, *payloads):
    texts = [(p if p is None or isinstance(p, str) else json.dumps(p, ensure_ascii=False),) for p in payloads]
    return spark.createDataFrame(texts, "payload string")
