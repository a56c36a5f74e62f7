"""The pass bands of the plant's stations (inclusive on both ends).

Spelling of the parameter names is that of the measurement log.
"""

from linepareto.operators.limits import Limit

VISION_065 = (
    Limit("065", "eq", "Value Height Pin X", None, 39, 47),
    Limit("065", "eq", "Value Pixle Area Pin X", None, 5000, 12000),
    Limit("065", "eq", "Value Blob X Feret Diameters Pin X", None, 2.6, 3.9),
    Limit("065", "eq", "Value Blob Y Feret Diameters Pin X", None, 1.2, 3.0),
    Limit("065", "eq", "Value Angle 1 Pin X", None, -45, 45),
    Limit("065", "eq", "Value Angle 2 Pin X", None, -45, 45),
    Limit("065", "eq", "Value Level Difference", None, 0, 0.6),
    Limit("065", "eq", "Value Pin 1 edge to stack edge", None, 0, 100000),
    Limit("065", "eq", "Value Pin 5 edge to stack edge", None, 0, 100000),
)

# Upper bound the longer reports use when tracing station 065 to its origin.
SUMMARY_VARIANT = "summary"
VISION_065_SUMMARY = (
    Limit("065", "eq", "Value Angle 2 Pin X", None, -45, -45, SUMMARY_VARIANT),
)

VISION_100 = (
    Limit("100", "eq", "Value height pin x", None, 47.6, 51.8),
    Limit("100", "eq", "Value Blob Y Feret Diameters Pin X", None, 1.1, 2.5),
    Limit("100", "eq", "Value Blob X Feret Diameters Pin X", None, 1.85, 4),
    Limit("100", "eq", "Value Pixle Area Pin X", None, 2700, 10000),
    Limit("100", "eq", "Value Angle 1 Pin X", None, 15, 40),
    Limit("100", "eq", "Value Angle 2 Pin X", None, -40, -15),
    Limit("100", "eq", "Value Level Difference", None, 0, 0.95),
    Limit("100", "ilike", "%defect%", None, 0, 0.4),
    Limit("100", "ilike", "%OD Outer Winding Grayscale%", None, 0, 6),
    Limit("100", "ilike", "Value Label Label OD Winding Grayscale", None, 0, 0),
    Limit("100", "ilike", "Value Label OD Winding Grayscale", None, 0, 0),
    Limit("100", "ilike", "Value Label OD Pins Grayscale", None, 0, 0),
    Limit("100", "ilike", "Value Label ID", None, 0, 0),
)

ELECTRICAL_110 = (
    Limit("110", "eq", "AmbientTemperature Value", None, 0, 50),
    Limit("110", "eq", "Area Waveform UV Value", None, -10, 3),
    Limit("110", "eq", "Area Waveform VW Value", None, -10, 3),
    Limit("110", "eq", "Area Waveform WU Value", None, -10, 3),
    Limit("110", "eq", "Humidity Value", None, 0, 100),
    Limit("110", "eq", "InbalanceOfAllPhasesU Value", None, 0, 1.5),
    Limit("110", "eq", "PartTemperature Value", None, 0, 100),
    Limit("110", "eq", "PhaseResistance between UV Value", None, 10.637, 11.523),
    Limit("110", "eq", "PhaseResistance between VW Value", None, 10.637, 11.523),
    Limit("110", "eq", "PhaseResistance between WU Value", None, 10.637, 11.523),
    Limit("110", "eq", "Withstand Current UVW to GND Value", None, 0, 15),
    Limit("110", "eq", "Withstand Voltage UVW to GND Value", None, 1400, 10000),
)

ELECTRICAL_210 = (
    Limit("210", "eq", "AmbientTemperature Value", 1, 0, 50),
    Limit("210", "eq", "AmbientTemperature Value", 2, 0, 50),
    Limit("210", "eq", "Area Waveform UV Value", 2, -3, 3),
    Limit("210", "eq", "Area Waveform VW Value", 2, -3, 3),
    Limit("210", "eq", "Area Waveform WU Value", 2, -3, 3),
    Limit("210", "eq", "Humidity Value", 2, 0, 100),
    Limit("210", "eq", "InbalanceOfAllPhasesU Value", 1, 0, 1.5),
    Limit("210", "eq", "Insulation Resistance UVW to GND Value", 1, 200, 10000),
    Limit("210", "eq", "Insulation Voltage UVW to GND Value", 1, 450, 550),
    Limit("210", "eq", "PartTemperature Value", 1, 0, 100),
    Limit("210", "eq", "Pdiv HvAc Value", 1, 800, 10000),
    Limit("210", "eq", "Pdiv UV Value", 2, 1400, 10000),
    Limit("210", "eq", "Pdiv VW Value", 2, 1400, 10000),
    Limit("210", "eq", "Pdiv WU Value", 2, 1400, 10000),
    Limit("210", "eq", "PhaseResistance between UV Value", 1, 10.637, 11.523),
    Limit("210", "eq", "PhaseResistance between VW Value", 1, 10.637, 11.523),
    Limit("210", "eq", "PhaseResistance between WU Value", 1, 10.637, 11.523),
    Limit("210", "eq", "Withstand Current UVW to GND Value", 1, 0, 15),
    Limit("210", "eq", "Withstand Voltage UVW to GND Value", 2, 1850, 1950),
)
