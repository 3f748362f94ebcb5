from odolake.functions import clock, distance, markup, numbers, responses, text

__all__ = ["clock", "distance", "markup", "numbers", "responses", "text"]
