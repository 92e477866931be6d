"""Texts of the answer chunks.

Fixed values: stored chunks and their hashes depend on every character. A text
holds {field} places; a tuple is (field, text when it is set, text when not).
"""

TEMPLATES = {
    "P1": 'En la planta {planta_canon}, el punto de medición {punto_nro} ("{nombre_punto}", máquina generadora {maquina_gen_nombre}) registró la concentración más alta de polvo respirable durante la semana {semana_nro} de {anio}: {concentracion_mg_m3} mg/m³ (fecha de medición {fecha_medicion}). Estado de la medición: {estado}. Ámbito: {ambito}.',
    "P2": 'En la planta {planta_canon}, el punto de medición {punto_nro} ("{nombre_punto}", máquina generadora {maquina_gen_nombre}) registró la concentración más baja de polvo respirable durante la semana {semana_nro} de {anio}: {concentracion_mg_m3} mg/m³ (fecha de medición {fecha_medicion}). Estado de la medición: {estado}. Ámbito: {ambito}.',
    "P3": "La planta {planta_canon} registró un promedio de {promedio_mg_m3} mg/m³ de polvo respirable a partir de {n_mediciones} mediciones. El valor máximo observado fue {maximo_mg_m3} mg/m³ y el mínimo {minimo_mg_m3} mg/m³. Ámbito: {ambito}.",
    "P4": (
        (
            "planta_canon",
            "La planta {planta_canon} registró un promedio de {promedio_mg_m3} mg/m³ de polvo respirable a partir de {n_mediciones} mediciones (máximo {maximo_mg_m3} mg/m³, mínimo {minimo_mg_m3} mg/m³).",
            "Considerando todas las plantas, el promedio global de polvo respirable fue {promedio_mg_m3} mg/m³ sobre {n_mediciones} mediciones (máximo {maximo_mg_m3} mg/m³, mínimo {minimo_mg_m3} mg/m³).",
        ),
        " Ámbito: {ambito}.",
    ),
    "P5": "La planta con los puntos de medición más altos es {planta_canon}, con un promedio de {promedio_mg_m3} mg/m³ de polvo respirable sobre {n_mediciones} mediciones. Su valor pico fue {pico_mg_m3} mg/m³. Ámbito: {ambito}.",
    "P6": "La planta con los puntos de medición más bajos es {planta_canon}, con un promedio de {promedio_mg_m3} mg/m³ de polvo respirable sobre {n_mediciones} mediciones. Su valor mínimo fue {minimo_mg_m3} mg/m³. Ámbito: {ambito}.",
    "P7": (
        ("es_causa_principal", "Causa principal: ", "Causa contribuyente ({peso_causa}): "),
        "{causa_descripcion}. Tipo de causa: {tipo_causa} (familia {familia_causa}). Severidad: {severidad}. Condición: {condicion_nombre}. Problema raíz: {problema_raiz_nombre}.",
    ),
    "P8": (
        'La máquina {equipo_denom} (tipo {tipo_equipo}, familia {familia_equipo}) en la planta {planta_canon} no tuvo mantención: la orden de trabajo {ot_relacionada} no se ejecutó por motivo "{motivo_no_ejecucion}".',
        ("fecha_reprogramacion", " Fue reprogramada para {fecha_reprogramacion}.", ""),
        " Año {anio}, semana {semana_nro}.",
    ),
    "P9": 'En la planta {planta_canon}, el punto de medición {punto_nro} ("{nombre_punto}") fue medido el {fecha_medicion} (semana {semana_nro} de {anio}) entre las {hora_inicio} y las {hora_termino}. Concentración registrada: {concentracion_mg_m3} mg/m³. Estado: {estado}.',
    "P10": 'En la planta {planta_canon}, el punto de medición {punto_nro} ("{nombre_punto}") fue medido el {fecha_medicion} (semana {semana_nro} de {anio}). Operador de panel: {operador_panel}. Técnico en higiene: {tecnico_higiene}.',
    "P11": 'En la planta {planta_canon}, el punto de medición {punto_nro} ("{nombre_punto}") no fue medido en la semana {semana_nro} de {anio} (fecha de inicio de semana {fecha_inicio_semana}). Estado: {estado}. Motivo: {motivo_no_medicion}.',
    "P12": 'En la planta {planta_canon}, la máquina {maquina_gen_nombre} (punto de medición {punto_nro}, "{nombre_punto}") fue medida durante la semana {semana_nro} de {anio} el día {fecha_medicion}. Concentración registrada: {concentracion_mg_m3} mg/m³.',
    "P13": "En la planta {planta_canon}, la ventana de 4 semanas con mayor número de puntos con alto grado de polución comprende desde la semana {semana_inicio} hasta la semana {semana_fin} de {anio}, con {n_altos_ventana} eventos sobre el límite.",
    "P14": "El punto de medición {punto_nro} concentró sus altas concentraciones (≥ 2.5 mg/m³) entre la semana {desde} y la semana {hasta} de {anio}, con un total de {n_eventos} eventos sobre el límite.",
    "P15": "El punto de medición {punto_nro} concentró sus bajas concentraciones (entre 0.01 y 1.0 mg/m³) entre la semana {desde} y la semana {hasta} de {anio}, con un total de {n_eventos} eventos bajo el umbral.",
    "P16": "En la planta {planta_canon}, la ventana de 4 semanas con mayor número de puntos con bajo grado de polución comprende desde la semana {semana_inicio} hasta la semana {semana_fin} de {anio}, con {n_bajos_ventana} eventos bajo el umbral.",
    "P17": 'La planta {planta_canon} muestra una tendencia creciente en polución (pendiente {pendiente} mg/m³ por semana, R² {r2}). Punto de medición {punto_nro} ("{nombre_punto}") con promedio histórico de {promedio_punto} mg/m³.',
    "P18": 'La última mantención de la máquina {equipo_denom} se realizó en la semana {semana_nro} de {anio} (fecha programada {inicio_programado}) mediante la orden de trabajo {orden_nro} ("{ot_texto_breve}"). Horas-hombre reales utilizadas: {hh_reales}. Responsable: {responsable_nombre}.',
    "P19": "La mantención de la máquina {equipo_denom} fue realizada por {responsable_nombre} mediante la orden de trabajo {orden_nro} en la semana {semana_nro} de {anio}.",
    "P20": "En la mantención de la máquina {equipo_denom} (orden de trabajo {orden_nro}, semana {semana_nro} de {anio}) trabajaron {personas_que_trabajaron} personas (planificadas: {personas_planificadas}).",
    "P21": "La última mantención de la máquina {equipo_denom} se realizó en la fecha {fecha_planificada} (semana {semana_nro} de {anio}) mediante la orden de trabajo {orden_nro}.",
    "P22": 'La orden de trabajo {orden_nro} sobre la máquina {equipo_denom} ("{ot_texto_breve}", semana {semana_nro} de {anio}) planificó {hh_planificadas} horas-hombre y consumió {hh_reales} horas-hombre reales (desviación {desviacion_hh} HH). Duración planificada: {duracion_planificada} h. Duración real: {duracion_real} h.',
    "P23": 'La orden de trabajo {orden_nro} sobre la máquina {equipo_denom} ("{ot_texto_breve}") originalmente programada para {fecha_original} no se ejecutó por motivo "{motivo_no_ejecucion}" y fue reprogramada para {fecha_reprogramacion}.',
    "P24": (
        'La máquina {equipo_denom} (ubicación técnica {ubicacion_tecnica}, tipo {tipo_equipo}, familia {familia_equipo}) en la planta {planta_canon} no fue mantenida en la fecha programada {fecha_programada}. Orden de trabajo {orden_nro} ("{ot_texto_breve}"), semana {semana_nro} de {anio}. Motivo: {motivo_no_ejecucion}.',
        ("fecha_reprogramacion", " Reprogramada para {fecha_reprogramacion}.", ""),
    ),
    "P25": 'La orden de trabajo {orden_nro} ("{ot_texto_breve}") sobre la máquina {equipo_denom} en la planta {planta_canon} se encuentra actualmente en ejecución. Fecha programada de inicio: {inicio_programado}. Semana {semana_nro} de {anio}.',
    "P26": 'La orden de trabajo {orden_nro} ("{ot_texto_breve}") sobre la máquina {equipo_denom} (ubicación técnica {ubicacion_tecnica}, tipo {tipo_equipo}) en la planta {planta_canon} tiene fecha programada de inicio {inicio_programado} y {hh_planificadas} horas-hombre planificadas.',
}
